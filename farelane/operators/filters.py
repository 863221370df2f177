"""Row-quality filters built from a rule set."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions import measures
from farelane.functions.ratios import percent, ratio
from farelane.model import CANONICAL, DROPOFF, PICKUP, WITHOUT_SPEED, RuleSet


def meets(rules: RuleSet) -> Column:
    """Whether a raw trip meets every rule; NULL (not kept) where an operand is null.

    Tests on stored columns come first: they reach the parquet scan, the ones on
    computed duration and speed cannot.
    """
    limits = {
        "fare_amount": rules.fare,
        "total_amount": rules.total,
        "tip_amount": rules.tip,
        "trip_distance": rules.distance,
        "passenger_count": rules.passengers,
    }
    tests = [F.col(name).between(*bounds) for name, bounds in limits.items() if bounds]
    tests.append(F.col("VendorID").isin(*rules.vendors))
    for location in (F.col("PULocationID"), F.col("DOLocationID")):
        tests.append(location > 0 if rules.positive_locations else location.isNotNull())
    tests += [
        F.col(PICKUP).isNotNull(),
        F.col(DROPOFF).isNotNull(),
        F.col(DROPOFF) > F.col(PICKUP),
    ]
    if rules.minutes:
        tests.append(measures.duration_minutes().between(*rules.minutes))
    if rules.max_speed is not None:
        tests.append(measures.speed_mph() <= rules.max_speed)
    return reduce(and_, tests)


def keep_valid(df: DataFrame, rules: RuleSet = CANONICAL) -> DataFrame:
    return df.where(meets(rules))


def filter_report(df: DataFrame, rules: RuleSet = WITHOUT_SPEED) -> DataFrame:
    """One row: how many trips the rules keep and remove. One scan."""
    counts = df.agg(
        F.count("*").alias("original_records"),
        F.count_if(meets(rules)).alias("filtered_records"),
    ).withColumn("removed_records", F.col("original_records") - F.col("filtered_records"))
    return counts.withColumns(
        {
            "removal_rate": F.coalesce(percent("removed_records", "original_records"), F.lit(0.0)),
            "quality_score": F.coalesce(ratio("filtered_records", "original_records"), F.lit(0.0)),
        }
    )


def filter_with_report(df: DataFrame, rules: RuleSet = WITHOUT_SPEED) -> tuple[DataFrame, DataFrame]:
    """The kept trips and the report about them, both lazy."""
    return keep_valid(df, rules), filter_report(df, rules)
