"""Monthly trip files and the trip view of the order tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from string import Formatter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.model import TRIP_SCHEMA

# Fixed value: file name of one month.
FILE_NAME = "yellow_tripdata_{year}-{month:02d}.parquet"

Month = tuple[int, int]


def file_name(year: int, month: int, template: str = FILE_NAME) -> str:
    return template.format(year=year, month=month)


def month_path(root: str, year: int, month: int, template: str = FILE_NAME) -> str:
    return f"{root.rstrip('/')}/{file_name(year, month, template)}"


def month_label(year: int, month: int) -> str:
    return f"{year}-{month:02d}"


def months_between(first: Month, last: Month) -> list[Month]:
    """All months from ``first`` to ``last``, both included."""
    numbers = range(first[0] * 12 + first[1] - 1, last[0] * 12 + last[1])
    return [(number // 12, number % 12 + 1) for number in numbers]


def month_is_available(spark: SparkSession, root: str, year: int, month: int, template: str = FILE_NAME) -> tuple[bool, str]:
    """Whether the month file exists and has a row, and its path."""
    path = month_path(root, year, month, template)
    try:
        return not spark.read.parquet(path).limit(1).isEmpty(), path
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False, path
        raise


def conform(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """Cast the known columns to their declared types and keep any further ones.

    Files of different months store the same column in different widths and
    spellings, so names are matched without case and types by cast. Where a file has
    two spellings of a column, the first that is not null counts. Texts that are no value
    of the type become null (see ``unreadable``). Times stored without zone are read in the
    session time zone (UTC by default).
    """
    rows, names = _by_place(df)
    known = [F.coalesce(*_values(rows, names, f), F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    expected = {field.name.lower() for field in schema}
    further = [rows[place].alias(name) for place, name in zip(rows.columns, names) if name.lower() not in expected]
    return rows.select(*known, *further)


def _by_place(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with columns named by place, as names that differ in case only cannot be told apart, and its names."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), df.columns


def _values(rows: DataFrame, names: Sequence[str], field: T.StructField) -> list[Column]:
    """The column in each of its spellings, in the declared type."""
    own = [f for f, name in zip(rows.schema, names) if name.lower() == field.name.lower()]
    return [
        rows[f.name].try_cast(field.dataType) if isinstance(f.dataType, T.StringType) else rows[f.name].cast(field.dataType)
        for f in own
    ]


def unreadable(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """One row: per column of ``schema`` the texts of ``df`` that are no value of its type."""
    rows, names = _by_place(df)
    counts = []
    for field in schema:
        bad = [F.count_if(_is_unreadable(rows[c], field)) for c in _text_places(rows, names, field)]
        counts.append(reduce(lambda a, b: a + b, bad, F.lit(0).cast("bigint")).alias(field.name))
    return rows.agg(*counts)


def unreadable_values(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> DataFrame | None:
    """(column_name, raw_value, reason, source_file, ingestion_month) per text of ``df`` that is no value of its column's type.

    ``df`` has the lineage columns of ``raw_months``. None where its files store no such column as text, so that
    nothing has to be read.
    """
    rows, names = _by_place(df)
    found = [
        F.when(
            _is_unreadable(rows[c], field),
            F.struct(F.lit(field.name).alias("column_name"), rows[c].alias("raw_value"), F.lit(f"no {field.dataType.simpleString()}").alias("reason")),
        )
        for field in schema
        for c in _text_places(rows, names, field)
    ]
    if not found:
        return None
    lineage = [rows[c].alias(n) for c, n in zip(rows.columns, names) if n in ("source_file", "ingestion_month")]
    return rows.select(F.inline(F.array_compact(F.array(*found))), *lineage)


def _text_places(rows: DataFrame, names: Sequence[str], field: T.StructField) -> list[str]:
    """The spellings of a column that is not text, where they are stored as text."""
    if isinstance(field.dataType, T.StringType):
        return []
    return [f.name for f, name in zip(rows.schema, names) if name.lower() == field.name.lower() and isinstance(f.dataType, T.StringType)]


def _is_unreadable(value: Column, field: T.StructField) -> Column:
    return value.isNotNull() & value.try_cast(field.dataType).isNull()


def with_lineage(df: DataFrame, source_file, ingestion_month) -> DataFrame:
    """Raw-layer columns: load time, source file and month of the load."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": source_file,
            "ingestion_month": ingestion_month,
        }
    )


def raw_months(spark: SparkSession, root: str, months: Iterable[Month], template: str = FILE_NAME) -> list[DataFrame]:
    """The month files as they are, with source_file and ingestion_month; one frame per schema they come in.

    Files of one schema are one scan, however many they are; a row's file and month are read off its path.
    """
    paths = [month_path(root, *month, template) for month in months]
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    # Reading a footer is a wait for storage; the driver waits for several at a time.
    with ThreadPoolExecutor(8) as pool:
        for path, schema in zip(paths, pool.map(lambda p: spark.read.parquet(p).schema, paths)):
            by_schema.setdefault(schema.json(), (schema, []))[1].append(path)
    parts = [(text, field) for text, field, *_ in Formatter().parse(template)]
    pattern = "".join(re.escape(text) + (r"(\d+)" if field else "") for text, field in parts)
    fields = [field for _, field in parts if field]
    year, month = (F.regexp_extract("_metadata.file_path", pattern, fields.index(f) + 1) for f in ("year", "month"))
    lineage = F.regexp_extract("_metadata.file_path", pattern, 0).alias("source_file"), F.concat_ws("-", year, month).alias("ingestion_month")
    return [spark.read.schema(schema).parquet(*some).select("*", *lineage) for schema, some in by_schema.values()]


def conformed(raw: DataFrame) -> DataFrame:
    """A frame of ``raw_months`` in the declared types, with all lineage columns."""
    trips = conform(raw)
    return with_lineage(trips, F.col("source_file"), F.col("ingestion_month"))


def read_months(spark: SparkSession, root: str, months: Iterable[Month], template: str = FILE_NAME) -> DataFrame:
    """Several month files as one frame; a column absent from a file is null there."""
    return union_evolving([conformed(raw) for raw in raw_months(spark, root, months, template)])


def union_evolving(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name over frames whose column sets grew over time."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def month_slice(bronze: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one load month; prunes the partitions of the raw table."""
    return bronze.where(F.col("ingestion_month") == month_label(year, month))


def silver_month_slice(silver: DataFrame, year: int, month: int) -> DataFrame:
    return silver.where((F.col("pickup_year") == year) & (F.col("pickup_month") == month))


def order_trips(spark: SparkSession, folder: str, by_month: bool = False) -> DataFrame:
    """Trip view of ``lineitem`` and ``orders``, used where no trip files exist.

    It contains invalid vendors, unknown codes, reversed and too fast trips on
    purpose. Times are built as seconds since 1970: adding intervals to a
    timestamp goes through calendar objects and costs many times as much.

    Both inputs grow with the data, so the join carries no broadcast hint; Spark
    checks the sizes, and adaptive execution splits a skewed order key. With ``by_month``
    the rows come by month of the order, for a write that is partitioned by it: they are
    shuffled as the few columns of the tables, before the trip columns are made.
    """
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    line, part, supplier = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    midnight = F.unix_date(F.to_date("o_orderdate")) * F.lit(86400).cast("bigint")
    start = midnight + (F.col("l_orderkey") * 7919 + line * 3571) % 86400
    end = start + (F.col("l_orderkey") * 31 + part * 17) % 7200 - 300
    fare = F.col("l_extendedprice") / 100
    extra = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.5)
    values = {
        "VendorID": supplier % 3 + 1,
        "tpep_pickup_datetime": F.timestamp_seconds(start),
        "tpep_dropoff_datetime": F.timestamp_seconds(end),
        "passenger_count": F.when(part % 19 != 0, part % 8),
        "trip_distance": F.col("l_quantity"),
        "RatecodeID": F.when(part % 8 == 7, 99).otherwise(part % 8),
        "store_and_fwd_flag": F.col("l_linestatus"),
        "PULocationID": supplier % 265,
        "DOLocationID": part % 265,
        "payment_type": line % 7,
        "fare_amount": fare,
        "extra": extra,
        "mta_tax": F.lit(0.5),
        "tip_amount": fare * F.col("l_discount"),
        "tolls_amount": F.col("l_tax") * 100,
        "improvement_surcharge": F.lit(0.3),
        "total_amount": fare * (1 + F.col("l_discount")) + F.col("l_tax") * 100 + extra + F.lit(3.3),
        "congestion_surcharge": F.lit(2.5),
        "airport_fee": F.lit(0.0),
    }
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if by_month:
        joined = joined.withColumn("_month", F.trunc("o_orderdate", "month")).hint("rebalance", "_month")
    return joined.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in TRIP_SCHEMA])
