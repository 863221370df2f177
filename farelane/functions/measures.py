"""Per-trip measures as expressions over the raw trip columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelane.functions.ratios import ratio_or_zero
from farelane.model import DROPOFF, PICKUP


def duration_minutes() -> Column:
    """Minutes between pickup and dropoff, each cut to whole seconds; may be <= 0."""
    return (F.unix_timestamp(DROPOFF) - F.unix_timestamp(PICKUP)) / F.lit(60.0)


def speed_mph() -> Column:
    return ratio_or_zero(F.col("trip_distance"), duration_minutes() / F.lit(60.0))


def tip_percentage() -> Column:
    fare = F.col("fare_amount")
    return F.when(fare > 0, F.col("tip_amount") / fare * F.lit(100.0)).otherwise(F.lit(0.0))


def cost_per_mile() -> Column:
    return ratio_or_zero(F.col("total_amount"), F.col("trip_distance"))


def revenue_per_minute() -> Column:
    return ratio_or_zero(F.col("total_amount"), duration_minutes())
