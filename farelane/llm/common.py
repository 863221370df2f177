"""Helpers shared by the text operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.session import working_folder

WHITE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


#: Spark's setting that frees the shuffle files of an execution at its end.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, purpose: str, free_shuffles: bool = False) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage at a place all executors reach, so a lost executor never
    repeats the work before it, and gives the planner true sizes: a landed
    frame is only broadcast below Spark's own size limit. With ``free_shuffles`` the shuffle files that led to
    it go at once, not when the driver has collected the plan: for chains of large steps, which would pile them up.
    """
    path = working_folder(df.sparkSession, purpose)
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, "false")
    conf.set(FREE_SHUFFLES, "true" if free_shuffles else before)
    try:
        df.write.parquet(path)
    finally:
        conf.set(FREE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        # The driver serves the archive to executors for as long as it lives.
        folder = tempfile.mkdtemp(prefix="package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        copy = Path(folder, "package", root.name)
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/{root.name}-{context.applicationId}", "zip", copy.parent))
        _shipped.add(context.applicationId)


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def normal_line(line: Column) -> Column:
    """Lower-case (A-Z), white space runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(ascii_lower(line), WHITE, " "))


def columns_of(df: DataFrame, **changed: Column) -> list[Column]:
    """All columns of ``df`` in order, whatever their names, with some changed."""
    return [changed[c].alias(c) if c in changed else df[f"`{c}`"] for c in df.columns]


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
