"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions import calendar, measures
from farelane.model import PICKUP


def add_temporal_features(df: DataFrame, timestamp: str = PICKUP) -> DataFrame:
    """Nine calendar columns of ``timestamp``."""
    hour, day_of_week = F.hour(timestamp), F.dayofweek(timestamp)
    return df.withColumns(
        {
            "pickup_hour": hour,
            "pickup_day": F.dayofmonth(timestamp),
            "pickup_month": F.month(timestamp),
            "pickup_year": F.year(timestamp),
            "pickup_dayofweek": day_of_week,
            "pickup_dayname": calendar.day_name(day_of_week),
            "time_period": calendar.period(hour),
            "is_weekend": calendar.is_weekend(day_of_week),
            "is_business_hour": calendar.is_business_hour(hour),
        }
    )


def add_trip_metrics(df: DataFrame) -> DataFrame:
    """Five per-trip ratios."""
    return df.withColumns(
        {
            "trip_duration_minutes": measures.duration_minutes(),
            "avg_speed_mph": measures.speed_mph(),
            "tip_percentage": measures.tip_percentage(),
            "cost_per_mile": measures.cost_per_mile(),
            "revenue_per_minute": measures.revenue_per_minute(),
        }
    )


def add_derived_columns(df: DataFrame) -> DataFrame:
    """The ten derived columns of the silver table."""
    hour, day_of_week = F.hour(PICKUP), F.dayofweek(PICKUP)
    return df.withColumns(
        {
            "trip_duration_minutes": measures.duration_minutes(),
            "avg_speed_mph": measures.speed_mph(),
            "pickup_hour": hour,
            "pickup_dayofweek": day_of_week,
            "pickup_dayname": calendar.day_name(day_of_week),
            "pickup_month": F.month(PICKUP),
            "pickup_year": F.year(PICKUP),
            "time_period": calendar.period(hour),
            "is_weekend": calendar.is_weekend(day_of_week),
            "tip_percentage": measures.tip_percentage(),
        }
    )
