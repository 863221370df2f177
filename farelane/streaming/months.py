"""The month load as an incremental file stream.

New month files are picked up once each and pass through the same silver rules
as in the batch load. A file stream remembers its files in the checkpoint, and a
repeated batch replaces its own output, so every file counts exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farelane.model import CANONICAL, RuleSet
from farelane.plans.gold import daily_basic
from farelane.plans.silver import valid_trips
from farelane.sources.trips import conform, with_lineage
from farelane.store.tables import write_partitions


def month_files(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Trip rows of the month files under ``root`` as a stream, with lineage columns."""
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "yellow_tripdata_*.parquet").parquet(root)
    named = conform(rows.select("*", F.col("_metadata.file_name").alias("_file")))
    label = F.regexp_extract("_file", r"_(\d{4}-\d{2})\.parquet$", 1)
    return with_lineage(named, F.col("_file"), label).drop("_file")


def load_new_files(
    stream: DataFrame, silver_path: str, checkpoint: str, rules: RuleSet = CANONICAL, daily_path: str | None = None
) -> StreamingQuery:
    """Append the valid trips of all files not seen yet, then stop.

    Every batch writes the partition of its own number, so a batch repeated
    after a failure overwrites itself. Outlier bounds need the whole month and
    stay with the batch load. ``daily_path`` keeps daily totals: a batch computes the pickup
    months it touches anew from all trips written so far, so months may come in any order
    and the totals are those of a batch build.
    """
    months = ("pickup_year", "pickup_month")

    def write(batch: DataFrame, number: int) -> None:
        rows = valid_trips(batch, rules).withColumn("batch", F.lit(number))
        write_partitions(rows, silver_path, ("batch", *months))
        if daily_path:
            trips = batch.sparkSession.read.parquet(silver_path)
            touched = trips.where(F.col("batch") == number).select(*months).distinct()
            write_partitions(daily_basic(trips.join(touched, list(months), "left_semi")), daily_path, months)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
