"""Layers the registered queries read: written once per session, as a real run writes them.

The trips of the order tables are the bronze table of a namespace of their own in the catalog; ``build_silver`` makes
the silver table and the outlier bounds from it, and gold tables and analyses read silver. Without the written tables every query
would repeat the join of ``lineitem`` and ``orders``, and every report on flags
the quartile passes. A layer belongs to the files it was made from: where one is
added, gone or newer, it is written anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions import calendar
from farelane.model import BOUNDS, BRONZE, PICKUP, SILVER, TRIP_SCHEMA
from farelane.plans import gold
from farelane.session import working_folder
from farelane.sources import trips as source
from farelane.store import loads, tables

_landed: dict[tuple, str | DataFrame] = {}


def raw_trips(spark: SparkSession, folder: str, by_month: bool = False) -> DataFrame:
    """Trips straight from the order tables, with the lineage columns of a month load."""
    # The twins know no time zones.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    month = calendar.month_text(PICKUP)
    file_name = F.concat(F.lit("yellow_tripdata_"), month, F.lit(".parquet"))
    return source.with_lineage(source.order_trips(spark, folder, by_month), file_name, month)


def once(spark: SparkSession, folder: str, name: str, make: Callable[[], str | DataFrame]):
    """What ``make`` gives, made once for these files in this application."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, _files(spark, folder), name)
    if key not in _landed:
        _landed[key] = make()
    return _landed[key]


def new_namespace(spark: SparkSession) -> str:
    """Databases for one set of layers, in the shared folder."""
    namespace = f"w{uuid.uuid4().hex[:12]}_"
    for database in ("bronze", "silver", "gold", "control"):
        spark.sql(f"CREATE DATABASE {namespace}{database} LOCATION '{working_folder(spark, database)}'")
    return namespace


def _namespace(spark: SparkSession, folder: str) -> str:
    return once(spark, folder, "namespace", lambda: new_namespace(spark))


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    spec = BRONZE.within(_namespace(spark, folder))

    def make() -> str:
        tables.replace_slice(raw_trips(spark, folder, by_month=True), spec, F.lit(True), even_files=False)
        return spec.name

    return spark.table(once(spark, folder, "bronze", make))


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """The bronze table without its lineage columns."""
    return bronze(spark, folder).select(*TRIP_SCHEMA.names)


def _silver(spark: SparkSession, folder: str) -> str:
    """The namespace, once its silver table and bounds are built."""
    bronze(spark, folder)
    namespace = _namespace(spark, folder)

    def make() -> str:
        loads.build_silver(spark, loads.LoadConfig(namespace=namespace))
        return namespace

    return once(spark, folder, "silver", make)


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(SILVER.within(_silver(spark, folder)).name)


def bounds(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(BOUNDS.within(_silver(spark, folder)).name)


GOLD_BUILDERS = {
    "daily": gold.daily,
    "hourly": gold.hourly,
    "location": gold.location,
    "vendor": gold.vendor,
    "payment": gold.payment,
    "time_series": gold.time_series,
    "route": gold.route,
    "financial": gold.financial,
}


def gold_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A gold table, built from silver once and read by the reports over it."""
    build = GOLD_BUILDERS[name]
    return lambda spark, folder: once(spark, folder, f"gold_{name}", lambda: tables.written(build(silver(spark, folder)), f"gold-{name}"))


def _files(spark: SparkSession, folder: str) -> tuple:
    """Path, size and time of each file of the two order tables; contents are not read."""
    found = []
    for table in ("lineitem", "orders"):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{folder}/{table}.parquet")
        found += [tuple(r) for r in files.select("path", "length", "modificationTime").collect()]
    return tuple(sorted(found))
