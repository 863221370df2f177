"""Partitioned table writes. One mode serves first load, further months and reloads."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.model import TableSpec
from farelane.session import working_folder


def new_path(spark: SparkSession, purpose: str) -> str:
    return working_folder(spark, purpose)


def balanced(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Few, even files per table partition.

    The rebalance hint shuffles by the partition columns and lets adaptive
    execution split a partition that is too large and merge small ones, so a
    month with a third of all trips does not end in one task.
    """
    return df.hint("rebalance", *partitions) if partitions else df.hint("rebalance")


def write_partitions(df: DataFrame, path: str, partitions: Sequence[str], even_files: bool = True) -> str:
    """Replace exactly the partitions that occur in ``df`` and keep all others."""

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").partitionBy(*partitions)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)

    if even_files:
        write(balanced(df, partitions))
    else:
        with _shown_in(_write_session(df.sparkSession), df) as shown:
            write(shown)
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read from there, for several uses."""
    path = new_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_database(spark: SparkSession, table: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")


def stamped(df: DataFrame, processing_id: str | None = None, as_of: datetime | None = None) -> DataFrame:
    """Processing time and, where given, the id of the run."""
    stamp = F.lit(as_of) if as_of else F.current_timestamp()
    columns = {"processing_timestamp": stamp}
    if processing_id:
        columns["processing_id"] = F.lit(processing_id)
    return df.withColumns(columns)


def save_table(df: DataFrame, spec: TableSpec, processing_id: str | None = None, mode: str = "overwrite") -> None:
    """Write the whole table with stamps; overwriting keeps the old table until the new one is complete."""
    rows = stamped(df, processing_id)
    if mode == "overwrite":
        replace_table(rows, spec)
        return
    ensure_database(df.sparkSession, spec.name)
    writer = balanced(rows, spec.partitions).write.mode(mode).format("parquet")
    if spec.partitions:
        writer = writer.partitionBy(*spec.partitions)
    writer.saveAsTable(spec.name)


def replace_table(rows: DataFrame, spec: TableSpec) -> None:
    """Make ``rows`` the table's content; the old one stays until they are complete."""
    if spec.partitions:
        replace_slice(rows, spec, F.lit(True))
    else:
        swap_in(balanced(rows, ()), spec)


def swap_in(rows: DataFrame, spec: TableSpec) -> None:
    """Write ``rows`` beside a table and let them take its name.

    ``rows`` may read the table itself. A failed write leaves the old table; at every moment
    one complete copy exists, at worst, after a stop between the renames, under the name
    ``<table>__old``.
    """
    spark = rows.sparkSession
    ensure_database(spark, spec.name)
    fresh, old = f"{spec.name}__new", f"{spec.name}__old"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    with _shown_in(_write_session(spark), rows) as shown:
        shown.write.format("parquet").partitionBy(*spec.partitions).saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if spark.catalog.tableExists(spec.name):
        _rename(spark, spec, spec.name, old)
    _rename(spark, spec, fresh, spec.name)
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _rename(spark: SparkSession, spec: TableSpec, name: str, new: str) -> None:
    """Rename a table and point its partitions to its new folder: not every catalog does so itself.

    A partition left pointing to the old folder would show, and on a drop delete, what another table has there.
    """
    spark.sql(f"ALTER TABLE {name} RENAME TO {new}")
    if not spec.partitions:
        return
    folder = next(r.data_type for r in describe(spark, new).collect() if r.col_name == "Location")
    where = ", ".join(f"`{column}` = :p{i}" for i, column in enumerate(spec.partitions))
    for (path,) in spark.sql(f"SHOW PARTITIONS {new}").collect():
        values = [unquote(part.split("=", 1)[1]) for part in path.split("/")]
        args = {f"p{i}": None if value == "__HIVE_DEFAULT_PARTITION__" else value for i, value in enumerate(values)}
        spark.sql(f"ALTER TABLE {new} PARTITION ({where}) SET LOCATION '{folder}/{path}'", args=args)
    spark.catalog.refreshTable(new)


#: Partitions a task writes side by side before it sorts the rest of its rows by partition.
OPEN_FILES = 16


def _write_session(spark: SparkSession, settings: dict[str, str] | None = None) -> SparkSession:
    """A session for one write, with the settings of ``spark``.

    Inserts know the overwrite mode as a session setting only, so they run in a session of
    their own, and loads that run side by side do not disturb each other. Few partitions of a task are written side by
    side, without a sort of whole rows that spills where a task's rows do not fit in memory.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    for key, value in (settings or {}).items():
        own.conf.set(key, value)
    return own


@contextmanager
def _shown_in(own: SparkSession, df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a frame of another session of the application."""
    name = f"rows_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        yield own.table(f"global_temp.{name}")
    finally:
        df.sparkSession.catalog.dropGlobalTempView(name)


def overwrite_partitions(
    spark: SparkSession, table: str, rows: Callable[[SparkSession], DataFrame], settings: dict[str, str] | None = None
) -> None:
    """Replace exactly the partitions of ``table`` that occur in ``rows``, which are read in the session of the write; columns by position."""
    rows(_write_session(spark, settings)).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)


def replace_slice(df: DataFrame, spec: TableSpec, part: Column, even_files: bool = True) -> None:
    """Make ``df`` the only content of the slice ``part`` of the table.

    ``part`` is a condition on partition columns that every row of ``df`` meets.
    ``df`` is computed once and written once: the insert keeps its files apart until all are complete, then swaps its
    partitions in, and partitions of the slice that got no rows are emptied. A failure before
    the swap leaves the old rows. The swap and the emptying are commits of their own: a stop
    between them leaves old rows in partitions the new slice no longer fills, and repeating the
    load removes them. Columns are matched by name: new ones are added to the table, missing
    ones are written as null, and where the new rows have a wider type the table is rewritten with it first.
    Without ``even_files`` nothing is shuffled, for rows that come by partition already.
    """
    spark = df.sparkSession
    ensure_database(spark, spec.name)
    rows = balanced(df, spec.partitions) if even_files else df
    own = _write_session(spark)
    if not spark.catalog.tableExists(spec.name):
        with _shown_in(own, rows) as shown:
            shown.write.format("parquet").partitionBy(*spec.partitions).saveAsTable(spec.name)
        return
    _widen_columns(df, spec)
    _add_new_columns(df, spec)
    aligned = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(spec.name).schema
    ]
    before = _files_of(spark, spec, part)
    with _shown_in(own, rows) as shown:
        shown.select(*aligned).write.mode("overwrite").insertInto(spec.name)
    spark.catalog.refreshTable(spec.name)
    # Partitions that got rows have new files only.
    stale = before & _files_of(spark, spec, part) if before else before
    for values in {file[:-1] for file in stale}:
        _empty_partition(spark, spec, values)


def _files_of(spark: SparkSession, spec: TableSpec, part: Column) -> set[tuple]:
    """Partition values and path of each file with rows in a slice; reads no other column."""
    rows = spark.table(spec.name).where(part).select(*spec.partitions, "_metadata.file_path").distinct().collect()
    return {tuple(row) for row in rows}


def partitions_of(spark: SparkSession, spec: TableSpec, part: Column) -> set[tuple]:
    """Partition values present in a slice; reads partition columns only."""
    rows = spark.table(spec.name).where(part).select(*spec.partitions).distinct().collect()
    return {tuple(row) for row in rows}


def _empty_partition(spark: SparkSession, spec: TableSpec, values: tuple) -> None:
    table = spark.table(spec.name)
    columns = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.schema if f.name not in spec.partitions
    )
    where = ", ".join(f"`{name}` = :p{i}" for i, name in enumerate(spec.partitions))
    spark.sql(
        f"INSERT OVERWRITE TABLE {spec.name} PARTITION ({where}) SELECT {columns} FROM range(1) WHERE false",
        args={f"p{i}": value for i, value in enumerate(values)},
    )


def _add_new_columns(df: DataFrame, spec: TableSpec) -> None:
    spark = df.sparkSession
    known = {name.lower() for name in spark.table(spec.name).columns}
    new = [f for f in df.schema if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {spec.name} ADD COLUMNS ({columns})")


# Numeric types in the order in which the next one holds all values of the one before; an integer also fits a double up to 2^53.
_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_REALS = ("float", "double")


def wider_type(old: str, new: str) -> str:
    """The type that holds the values of both, or an error where none of the two types and no real type does."""
    if old == new:
        return old
    for order in (_INTEGERS, _REALS):
        if old in order and new in order:
            return max(old, new, key=order.index)
    if {old, new} <= {*_INTEGERS, *_REALS}:
        return "double"
    if {old, new} in ({"date", "timestamp"}, {"date", "timestamp_ntz"}):
        return next(t for t in (old, new) if t != "date")
    if "string" in (old, new):
        return "string"
    raise ValueError(f"no common type for {old} and {new}")


def _widen_columns(df: DataFrame, spec: TableSpec) -> None:
    """Give the table the wider types that ``df`` brings, by a rewrite beside it that then takes its name.

    Partition columns keep their types; narrower columns of ``df`` are cast on writing. The table stays whole if the rewrite fails.
    """
    spark = df.sparkSession
    coming = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    table = spark.table(spec.name)
    wider = {
        f.name: wider_type(f.dataType.simpleString(), coming[f.name.lower()])
        for f in table.schema
        if f.name not in spec.partitions and f.dataType.simpleString() != coming.get(f.name.lower(), f.dataType.simpleString())
    }
    wider = {name: kind for name, kind in wider.items() if kind != table.schema[name].dataType.simpleString()}
    if wider:
        # Its files come by partition already, so nothing is shuffled.
        swap_in(table.withColumns({n: F.col(n).cast(kind) for n, kind in wider.items()}), spec)


def append_rows(df: DataFrame, spec: TableSpec) -> None:
    spark = df.sparkSession
    ensure_database(spark, spec.name)
    writer = df.write.mode("append").format("parquet")
    if spec.partitions:
        writer = writer.partitionBy(*spec.partitions)
    writer.saveAsTable(spec.name)


def analyze(spark: SparkSession, table: str) -> None:
    """Row count and column statistics for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {table}")


# Names the catalog gives its column statistics.
_STATISTICS = {"num_nulls": "bigint", "min": "string", "max": "string"}


def catalog_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(column_name, num_nulls, min, max) as the catalog holds them, values as text; null where it holds none."""
    rows = []
    for column in spark.table(table).columns:
        facts = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} `{column}`").collect()}
        known = [None if facts.get(name) in (None, "NULL") else facts[name] for name in _STATISTICS]
        rows.append((column, *known))
    read = spark.createDataFrame(rows, "column_name string, " + ", ".join(f"{n} string" for n in _STATISTICS))
    return read.select("column_name", *[F.col(n).cast(kind).alias(n) for n, kind in _STATISTICS.items()])


def check_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(column_name, known_nulls, nulls, same_range, is_stale) per column: the catalog's statistics against a census of the table.

    Least and greatest value are compared as numbers, dates and booleans; the catalog keeps none of texts. A column without
    statistics is stale. One scan of the table.
    """
    rows = spark.table(table)
    parts = []
    for f in rows.schema:
        value = F.col(f"`{f.name}`")
        ends = [(F.lit(None) if f.dataType.simpleString() in ("string", "binary") else end(value)).cast("string") for end in (F.min, F.max)]
        facts = [F.lit(f.name), F.count("*") - F.count(value), *ends]
        parts.append(F.struct(*[x.alias(n) for x, n in zip(facts, ("column_name", "nulls", "low", "high"))]))
    census = rows.agg(F.array(*parts).alias("c")).select(F.inline("c"))
    known = catalog_statistics(spark, table).withColumnsRenamed({"num_nulls": "known_nulls"})
    both = census.join(known, "column_name", "left")
    same = F.col("low").eqNullSafe(F.col("min")) & F.col("high").eqNullSafe(F.col("max"))
    stale = ~(F.col("nulls").eqNullSafe(F.col("known_nulls")) & F.col("same_range"))
    return both.withColumn("same_range", same).select("column_name", "known_nulls", "nulls", "same_range", stale.alias("is_stale"))
