"""Reports over raw trips, silver trips and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.partials import merged_avg, merged_sum, merged_trips, partial, with_distinct_counts
from farelane.model import PICKUP

# --- raw layer -------------------------------------------------------------


def bronze_month_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("ingestion_month").agg(F.count("*").alias("n_rows")).orderBy("ingestion_month")


def period_stats(bronze: DataFrame) -> DataFrame:
    """First and last pickup and the number of load months, as one row.

    Months are grouped first, so the distinct count is a row count.
    """
    months = bronze.groupBy("ingestion_month").agg(
        F.min(PICKUP).alias("first"), F.max(PICKUP).alias("last"), F.count("*").alias("n")
    )
    return months.agg(
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.count("ingestion_month").alias("distinct_months"),
        F.sum("n").alias("total_records"),
    )


def vendor_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("VendorID").agg(F.count("*").alias("n_rows")).orderBy("VendorID")


def bronze_money_stats(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg("total_amount").alias("avg_total"),
        F.max("total_amount").alias("max_total"),
        F.min("total_amount").alias("min_total"),
    )


# --- silver layer ----------------------------------------------------------


def silver_money_stats(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.avg("fare_amount").alias("avg_fare"),
        F.stddev("fare_amount").alias("std_fare"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg("tip_percentage").alias("avg_tip_pct"),
        F.avg("total_amount").alias("avg_total"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    )


def silver_month_counts(trips: DataFrame) -> DataFrame:
    counts = trips.groupBy("pickup_month", "pickup_year").agg(F.count("*").alias("n_rows"))
    return counts.orderBy("pickup_year", "pickup_month")


def by_vendor(trips: DataFrame) -> DataFrame:
    return _profile(trips, "vendor_name", avg_fare="fare_amount", avg_tip_pct="tip_percentage").orderBy(
        F.desc("trips"), "vendor_name"
    )


def by_period(trips: DataFrame) -> DataFrame:
    return _profile(trips, "time_period", avg_fare="fare_amount", avg_distance="trip_distance").orderBy(
        F.desc("trips"), "time_period"
    )


def by_weekend(trips: DataFrame) -> DataFrame:
    return _profile(
        trips, "is_weekend", avg_fare="fare_amount", avg_tip_pct="tip_percentage", avg_distance="trip_distance"
    ).orderBy("is_weekend")


def top_routes_by_count(trips: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest routes; ids break ties so that the list is unique."""
    routes = trips.groupBy("PULocationID", "DOLocationID").agg(F.count("*").alias("trip_count"))
    return routes.orderBy(F.desc("trip_count"), "PULocationID", "DOLocationID").limit(k)


def kpi_overall(trips: DataFrame) -> DataFrame:
    keys = {"PULocationID": "unique_pickup_locations", "DOLocationID": "unique_dropoff_locations"}
    summed = ("total_amount", "trip_distance", "passenger_count", "trip_duration_minutes", "tip_percentage")
    routes = trips.groupBy(*keys).agg(*partial(summed))
    totals = F.struct(
        F.coalesce(merged_trips(), F.lit(0)).alias("total_trips"),
        merged_sum("total_amount").alias("total_revenue"),
        merged_sum("trip_distance").alias("total_distance"),
        merged_sum("passenger_count").alias("total_passengers"),
        merged_avg("total_amount").alias("avg_revenue_per_trip"),
        merged_avg("trip_distance").alias("avg_distance_per_trip"),
        merged_avg("trip_duration_minutes").alias("avg_duration_minutes"),
        merged_avg("tip_percentage").alias("avg_tip_percentage"),
    )
    return with_distinct_counts(routes, totals, keys)


def mini_hourly(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_hour").agg(
        F.count("*").alias("trip_count"),
        F.avg("total_amount").alias("avg_amount"),
        F.sum("total_amount").alias("total_revenue"),
    )


def mini_location(trips: DataFrame) -> DataFrame:
    return trips.groupBy("PULocationID").agg(
        F.count("*").alias("pickup_count"), F.avg("trip_distance").alias("avg_distance")
    )


def mini_summary(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count("*").alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_fare"),
        F.max("trip_distance").alias("max_distance"),
    )


# --- gold layer ------------------------------------------------------------


def vendor_rollup(vendor: DataFrame) -> DataFrame:
    """Totals per vendor; the tip rate is the plain mean of the monthly means."""
    return (
        vendor.groupBy("vendor_name")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("total_revenue").alias("total_revenue"),
            F.avg("avg_tip_percentage").alias("avg_tip_pct"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def hour_profile(hourly: DataFrame) -> DataFrame:
    """Mean trips and mean of mean revenues per hour of day, unweighted."""
    return (
        hourly.groupBy("pickup_hour")
        .agg(F.avg("total_trips").alias("avg_trips_per_hour"), F.avg("avg_revenue_per_trip").alias("avg_revenue"))
        .orderBy("pickup_hour")
    )


def weekend_daily(daily: DataFrame) -> DataFrame:
    """Mean day of weekends and of working days."""
    return daily.groupBy("is_weekend").agg(
        F.avg("total_trips").alias("avg_daily_trips"),
        F.avg("total_revenue").alias("avg_daily_revenue"),
        F.avg("avg_tip_percentage").alias("avg_tip_pct"),
        F.try_divide(F.sum("total_distance"), F.sum("total_trips")).alias("avg_distance"),
    )


def top_revenue_days(daily: DataFrame, k: int = 5) -> DataFrame:
    days = daily.select("trip_date", "total_revenue", "total_trips", "pickup_dayname")
    return days.orderBy(F.desc("total_revenue"), "trip_date").limit(k)


def top_profitable_routes(route: DataFrame, k: int = 10) -> DataFrame:
    routes = route.select(
        "PULocationID", "DOLocationID", "trip_count", "total_revenue", "avg_revenue_per_trip", "revenue_per_mile"
    )
    return routes.orderBy(F.desc("total_revenue"), "PULocationID", "DOLocationID").limit(k)


def monthly_growth(financial: DataFrame) -> DataFrame:
    return financial.select(
        "month_year", "total_trips", "gross_revenue", "trips_growth_rate", "revenue_growth_rate"
    ).orderBy("month_year")


def gold_consistency(daily: DataFrame, trips: DataFrame, tolerance: int = 100) -> DataFrame:
    """One row: trips in silver against the sum of the daily table."""
    total = daily.agg(F.coalesce(F.sum("total_trips"), F.lit(0)).alias("n"))
    counts = trips.agg(F.count("*").alias("silver_total")).withColumn("daily_total", total.scalar())
    difference = F.abs(F.col("silver_total") - F.col("daily_total"))
    return counts.withColumns({"difference": difference, "consistent": difference < tolerance})


#: Names under which the gold tables count their trips.
TRIP_COUNTS = ("total_trips", "trip_count", "trips_count", "pickup_count")


def gold_validation(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: rows, columns, and rows whose trip count is null.

    The count column is the table's own; a table without one reports NULL, as nothing was checked.
    """
    rows = None
    for name, table in tables.items():
        own = next((c for c in TRIP_COUNTS if c in table.columns), None)
        nulls = F.count_if(F.col(own).isNull()) if own else F.lit(None)
        row = table.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.lit(len(table.columns)).alias("n_columns"),
            nulls.cast("bigint").alias("null_total_trips"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def _profile(trips: DataFrame, key: str, **averages: str) -> DataFrame:
    means = [F.avg(column).alias(name) for name, column in averages.items()]
    return trips.groupBy(key).agg(F.count("*").alias("trips"), *means)
