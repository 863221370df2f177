"""Month files of two generations made from the trips, and a real sequence of loads over them.

A trip is in the file of the month of its dropoff, so files hold some trips picked up in the month before.
From 1998 on the files store the passenger count as text, with texts that are no number, and ``meter_id``, which was an int,
as a bigint. One month has no file. The loads: a backfill to the end of 1997, one of all
months after it, and one month once more.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import new_namespace, once, trips
from farelane.functions import calendar
from farelane.model import BRONZE, DROPOFF, GOLD, PICKUP, UNREADABLE, TableSpec, Thresholds
from farelane.session import working_folder
from farelane.sources.trips import Month
from farelane.store import layout, loads, runlog, tables

FILES = "month={year}-{month:02d}"
SECOND_GENERATION = "1998-01"
ABSENT = "1999-05"
AGAIN = (2000, 3)
#: Times of the three loads, and limits that some months of the small tables miss.
STARTS = (datetime(2024, 1, 20, 6), datetime(2024, 1, 30, 6), datetime(2024, 1, 31, 6))
LIMITS = Thresholds(min_records_per_file=700, min_quality_score=0.45)


def write_files(spark: SparkSession, folder: str) -> str:
    """The folder of the month files, one subfolder a month."""
    root = working_folder(spark, "month-files")
    rows = trips(spark, folder).withColumn("month", calendar.month_text(DROPOFF)).where(F.col("month") != ABSENT)
    early = F.col("month") < SECOND_GENERATION
    meter = F.col("PULocationID")
    tables.write_partitions(rows.where(early).withColumn("meter_id", meter), root, ("month",), even_files=False)
    count = F.when(F.col("payment_type") == 3, "n/a").otherwise(F.col("passenger_count").cast("string"))
    later = rows.where(~early).withColumns({"passenger_count": count, "meter_id": meter.cast("bigint") + 3_000_000_000})
    tables.write_partitions(later, root, ("month",), even_files=False)
    return root


def _month(label: str) -> Month:
    year, month = label.split("-")
    return int(year), int(month)


def run(spark: SparkSession, folder: str) -> str:
    """The namespace the loads ran in."""

    def make() -> str:
        root, namespace = write_files(spark, folder), new_namespace(spark)
        first, last = trips(spark, folder).agg(*[end(calendar.month_text(DROPOFF)) for end in (F.min, F.max)]).first()
        config = loads.LoadConfig(namespace=namespace, files=FILES, thresholds=LIMITS)
        for number, start in enumerate(STARTS, 1):
            at = replace(config, clock=lambda start=start: start, new_id=lambda label, number=number: f"load{number}_{label}")
            if number == 1:
                loads.backfill(spark, root, _month(first), (1997, 12), at)
                # Known to the catalog from here on, until the next load writes the table.
                tables.analyze(spark, GOLD["hourly"].within(namespace).name)
            elif number == 2:
                loads.backfill(spark, root, _month(SECOND_GENERATION), _month(last), at)
            else:
                loads.run_month(spark, root, *AGAIN, at)
        return namespace

    return once(spark, folder, "month-loads", make)


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log the loads wrote; of an error, the text up to the path of the file."""
    log = runlog.read_run_log(spark, run(spark, folder))
    return log.withColumn("error_message", F.regexp_replace("error_message", " at .*", ""))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.read_events(spark, run(spark, folder))


def gold_rows(name: str):
    """A gold table the loads wrote, without its stamps."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = spark.table(GOLD[name].within(run(spark, folder)).name).drop("processing_timestamp", "processing_id")
        return rows.drop("pickup_year", "pickup_month") if name == "hourly" else rows

    return query


def unreadable(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.table(UNREADABLE.within(run(spark, folder)).name)
    return rows.groupBy("ingestion_month", "source_file", "column_name", "raw_value", "reason").agg(F.count("*").alias("n_values"))


def widened(spark: SparkSession, folder: str) -> DataFrame:
    """The column that grew wider in later files, per month, and its type in the table."""
    rows = spark.table(BRONZE.within(run(spark, folder)).name)
    kind = rows.schema["meter_id"].dataType.simpleString()
    months = rows.groupBy("ingestion_month", "ingestion_year", "processing_execution_id")
    return months.agg(
        F.lit(kind).alias("type"), F.count("*").alias("n_rows"), F.min("meter_id").alias("least"), F.max("meter_id").alias("greatest")
    )


def compacted(spark: SparkSession, folder: str) -> DataFrame:
    """A table of which later months came in three parts, compacted: files per month before and after, and whether its files are the old ones."""

    def make() -> DataFrame:
        spec = TableSpec(f"{new_namespace(spark)}bronze.parts", ("month",), (PICKUP,))
        rows = trips(spark, folder).withColumn("month", calendar.month_text(PICKUP))
        late = F.col("month") >= SECOND_GENERATION
        tables.replace_slice(rows.where(~late), spec, F.lit(True))
        for part in range(3):
            tables.append_rows(tables.balanced(rows.where(late & (F.col("payment_type") % 3 == part)), spec.partitions), spec)
        before = tables.written(layout.file_census(spark, spec), "files-before")
        layout.compact_table(spark, spec)
        after = layout.file_census(spark, spec)
        both = before.join(after.select("path", F.lit(True).alias("stays")), "path", "left").groupBy("month").agg(
            F.count("*").alias("files_before"), F.count_if("stays").alias("files_kept")
        )
        spark.catalog.refreshTable(spec.name)
        counts = spark.table(spec.name).groupBy("month").agg(F.count("*").alias("n_rows"), F.sum("fare_amount").alias("fares"))
        files = after.groupBy("month").agg(F.count("*").alias("files_after"))
        return tables.written(both.join(files, "month").join(counts, "month"), "compacted")

    return once(spark, folder, "compacted", make)


#: Columns whose statistics are reported, per table.
STATISTICS = {
    "daily": ("trip_date", "pickup_year", "pickup_month", "pickup_day", "is_weekend", "total_trips", "active_vendors", "morning_trips"),
    "hourly": ("pickup_hour", "pickup_dayname", "total_trips"),
}


def statistics(spark: SparkSession, folder: str) -> DataFrame:
    """What the catalog knows of the daily table, analysed after its last load, and of the hourly one, analysed before."""
    namespace = run(spark, folder)

    def make() -> DataFrame:
        names = {table: GOLD[table].within(namespace).name for table in STATISTICS}
        tables.analyze(spark, names["daily"])
        found = [
            tables.check_statistics(spark, name).where(F.col("column_name").isin(*STATISTICS[table])).withColumn("table_name", F.lit(table))
            for table, name in names.items()
        ]
        return tables.written(found[0].unionByName(found[1]), "statistics")

    return once(spark, folder, "statistics", make)
