"""The registered queries: every operator applied to the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import month_loads
from checks.inputs import GOLD_BUILDERS, bounds, bronze, gold_table, raw_trips, silver, trips
from checks.month_loads import run_log
from farelane.functions import calendar
from farelane.model import (
    CANONICAL,
    CASH,
    LENIENT,
    PICKUP,
    TRIP_SCHEMA,
    WITHOUT_SPEED,
    TableSpec,
    Thresholds,
)
from farelane.operators import derive, enrich, filters, outliers, quality
from farelane.plans import gold, insights, monitoring, rollups
from farelane.plans import silver as layer
from farelane.plans.dashboards import view
from farelane.sources import trips as source
from farelane.store import tables

Query = Callable[[SparkSession, str], DataFrame]

# Limits that both pass and fail on the small test tables.
CHECKED_LIMITS = Thresholds(min_records_per_file=50, min_revenue_per_day=5.0, max_outlier_percentage=2.0)


# Means of money amounts often end exactly on half of the sixth digit, where the
# order of summation decides the rounding. The nudge moves such ties aside.
NUDGE = 3.1e-8
# From here on a double sum has fewer reliable digits after the point.
LARGE = 1e6


def rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order in the last bits; cut those off."""

    def cut(name: str):
        value = F.col(name) + F.lit(NUDGE)
        return F.when(F.abs(name) >= LARGE, F.round(value, 3)).otherwise(F.round(value, 6)).alias(name)

    return df.select(*[cut(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema])


# --- gold tables, shared by the queries over them ----------------------------


def gold_daily(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily(silver(spark, folder))


def gold_vendor(spark: SparkSession, folder: str) -> DataFrame:
    return gold.vendor(silver(spark, folder))


def gold_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return gold.hourly(silver(spark, folder))


def gold_financial(spark: SparkSession, folder: str) -> DataFrame:
    return gold.financial(silver(spark, folder))


def gold_route(spark: SparkSession, folder: str) -> DataFrame:
    return gold.route(silver(spark, folder))


def gold_payment(spark: SparkSession, folder: str) -> DataFrame:
    return gold.payment(silver(spark, folder))


def latest_run(log: DataFrame, hours: int):
    """A report time ``hours`` after the last run, read from the log itself."""
    return log.agg(F.timestamp_add("HOUR", F.lit(hours), F.max("start_time")).alias("t")).scalar()


def noon_of_last_day(rows: DataFrame):
    """A report time inside the data, so that some trips lie in its future."""
    return rows.agg(F.timestamp_add("HOUR", F.lit(-12), F.max(PICKUP)).alias("t")).scalar()


# --- queries ---------------------------------------------------------------


def text_times(df: DataFrame) -> DataFrame:
    """Timestamps as text, for comparison."""
    return df.withColumns(
        {
            f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
            for f in df.schema
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        }
    )


def bronze_ingest(spark, folder):
    return text_times(raw_trips(spark, folder).drop("ingestion_timestamp"))


def derived(columns: str, add: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark, folder):
        rows = trips(spark, folder)
        new = add(rows)
        return text_times(new.select(*KEY, *[c for c in new.columns if c not in rows.columns]))

    query.__doc__ = columns
    return query


# Columns that identify a trip in the row-level results.
KEY = ("VendorID", PICKUP, "PULocationID", "DOLocationID", "fare_amount", "tip_amount")


def kept(rules) -> Query:
    return lambda spark, folder: text_times(filters.keep_valid(trips(spark, folder), rules).select(*KEY))


def month_slice(spark, folder):
    rows = source.month_slice(bronze(spark, folder), 1999, 3)
    return rows.groupBy("ingestion_month", "VendorID").agg(
        F.count("*").alias("n_rows"), F.sum("total_amount").alias("total_revenue")
    )


def schema_evolve_union(spark, folder):
    """Months of two file generations: the later one has two more columns."""
    rows = bronze(spark, folder)
    early = F.col("ingestion_month") < "1999-01"
    old = rows.where(early).drop("congestion_surcharge", "airport_fee")
    new = rows.where(~early)
    return (
        source.union_evolving([old, new])
        .groupBy("ingestion_month")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("congestion_surcharge").alias("with_congestion_surcharge"),
            F.sum("congestion_surcharge").alias("congestion_surcharge"),
            F.count("airport_fee").alias("with_airport_fee"),
        )
    )


def month_replace(spark, folder):
    """Daily table of all months, then one month loaded again twice: nothing may change."""
    spec = TableSpec(f"month_replace_{uuid.uuid4().hex}.daily", ("pickup_year", "pickup_month"))
    trips = silver(spark, folder)
    month = source.silver_month_slice(trips, 1999, 3)
    tables.replace_slice(gold.daily_basic(trips), spec, F.lit(True))
    for _ in range(2):
        tables.replace_slice(gold.daily_basic(month), spec, (F.col("pickup_year") == 1999) & (F.col("pickup_month") == 3))
    # The result alone stays; the table goes with its database.
    path = tables.new_path(spark, "month-replace")
    spark.table(spec.name).write.parquet(path)
    spark.sql(f"DROP DATABASE {spec.name.split('.')[0]} CASCADE")
    return spark.read.parquet(path)


def silver_rows(spark, folder):
    rows = silver(spark, folder)
    return text_times(rows.drop("ingestion_timestamp", "silver_processing_timestamp"))


def outlier_flags(spark, folder):
    """The flags as the silver build wrote them."""
    rows = silver(spark, folder)
    flags = [c for c in rows.columns if c.endswith("_outlier")]
    return text_times(rows.select(*KEY, *flags))


def outlier_flags_narrow(spark, folder):
    """Flags by closer bounds, searched anew over the silver table."""
    rows = outliers.flag_outliers(silver(spark, folder), multiplier=0.5, by=layer.SCOPE)
    flags = [c for c in rows.columns if c.endswith("_outlier")]
    return text_times(rows.select(*KEY, *flags))


def schema_issues(spark, folder):
    rows = bronze(spark, folder).drop("airport_fee", "ingestion_timestamp").withColumn("extra", F.col("extra").cast("string"))
    found = quality.schema_issues(rows, TRIP_SCHEMA)
    size = rows.groupBy().agg(F.count("*").alias("n_rows"))
    return found.withColumn("n_rows", size.scalar())


def gold_validation(spark, folder):
    return rollups.gold_validation({name: gold_table(name)(spark, folder) for name in GOLD_BUILDERS})


def with_rows(report, rows=trips) -> Query:
    return lambda spark, folder: report(rows(spark, folder))


def quality_metrics(spark, folder):
    rows = trips(spark, folder)
    return quality.quality_metrics(rows, noon_of_last_day(rows))


def duplicate_count(spark, folder):
    """Duplicates among whole trips, where those paid in cash were loaded twice."""
    rows = trips(spark, folder)
    return quality.duplicate_count(rows.unionByName(rows.where(F.col("payment_type") == CASH)))


def quality_report(spark, folder):
    rows = trips(spark, folder)
    return quality.quality_report(rows, noon_of_last_day(rows))


def backfill_summary(spark, folder):
    """Outcome of all months ever tried."""
    return monitoring.outcomes(run_log(spark, folder))


def month_load_log(spark, folder):
    """The written run log without ids and times."""
    return run_log(spark, folder).select(
        "pipeline_name", "status", "stage", "records_processed", "records_bronze", "records_silver", "records_gold", "error_message", "quality_score"
    )


def health(hours: int) -> Query:
    def query(spark, folder):
        log = run_log(spark, folder)
        return text_times(monitoring.health(log, latest_run(log, hours)))

    return query


def mapped(add, code: str, label: str) -> Query:
    def query(spark, folder):
        rows = add(trips(spark, folder))
        return rows.groupBy(code, label).agg(F.count("*").alias("n_rows"))

    return query


def business_mappings(spark, folder):
    rows = enrich.add_business_mappings(trips(spark, folder))
    return text_times(rows.select(*KEY, "RatecodeID", "payment_type", "vendor_name", "rate_code_desc", "payment_type_desc"))


def _queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "bronze_ingest": bronze_ingest,
        "month_slice": month_slice,
        "month_replace": month_replace,
        "schema_evolve_union": schema_evolve_union,
        # projections and filters
        "derived_columns": derived("ten silver columns", derive.add_derived_columns),
        "temporal_features": derived("nine calendar columns", derive.add_temporal_features),
        "trip_metrics": derived("five ratios", derive.add_trip_metrics),
        "silver_filter": kept(CANONICAL),
        "silver_filter_helper": kept(WITHOUT_SPEED),
        "silver_filter_lenient": kept(LENIENT),
        "quality_filter_report": with_rows(filters.filter_report),
        "silver_rows": silver_rows,
        # code lists
        "map_vendor": mapped(enrich.add_vendor_name, "VendorID", "vendor_name"),
        "map_ratecode": mapped(enrich.add_rate_code, "RatecodeID", "rate_code_desc"),
        "map_payment": mapped(enrich.add_payment_type, "payment_type", "payment_type_desc"),
        "business_mappings": business_mappings,
        # quality
        "schema_issues": schema_issues,
        "bronze_quality": with_rows(quality.bronze_quality, bronze),
        "quality_metrics": quality_metrics,
        "duplicate_count": duplicate_count,
        "silver_quality_score": with_rows(quality.silver_quality_score),
        "silver_quality_by_month": lambda s, f: quality.silver_quality_score(silver(s, f), "pickup_year", "pickup_month"),
        "business_rules": with_rows(quality.business_rules),
        "threshold_checks": lambda s, f: quality.threshold_checks(bronze(s, f), silver(s, f), CHECKED_LIMITS),
        "summary_statistics": lambda s, f: text_times(quality.summary_statistics(trips(s, f))),
        "quality_report_long": quality_report,
        "quality_indicators": lambda s, f: quality.quality_indicators(trips(s, f), silver(s, f), layer.kept()),
        "cleaning_rate": with_rows(layer.cleaning_rate),
        # outliers
        "outlier_flags": outlier_flags,
        "outlier_flags_narrow": outlier_flags_narrow,
        "outlier_bounds": bounds,
        "outlier_summary": with_rows(outliers.outlier_summary, silver),
        "outlier_causes": with_rows(insights.outlier_causes, silver),
        # raw and silver reports
        "bronze_month_counts": with_rows(rollups.bronze_month_counts, bronze),
        "period_stats": lambda s, f: text_times(rollups.period_stats(bronze(s, f))),
        "vendor_counts": with_rows(rollups.vendor_counts),
        "bronze_money_stats": with_rows(rollups.bronze_money_stats),
        "silver_money_stats": with_rows(rollups.silver_money_stats, silver),
        "silver_month_counts": with_rows(rollups.silver_month_counts, silver),
        "silver_by_vendor": lambda s, f: rollups.by_vendor(silver(s, f)),
        "silver_by_period": with_rows(rollups.by_period, silver),
        "silver_by_weekend": with_rows(rollups.by_weekend, silver),
        "top_routes_by_count": with_rows(rollups.top_routes_by_count, silver),
        "kpi_overall": with_rows(rollups.kpi_overall, silver),
        "mini_hourly": with_rows(rollups.mini_hourly, silver),
        "mini_location": with_rows(rollups.mini_location, silver),
        "mini_summary": with_rows(rollups.mini_summary, silver),
        # gold tables
        "gold_daily": gold_daily,
        "gold_daily_lite": with_rows(gold.daily_basic, silver),
        "gold_hourly": gold_hourly,
        "gold_hourly_lite": with_rows(gold.hourly_basic, silver),
        "gold_location": with_rows(gold.location, silver),
        "gold_location_neutral": lambda s, f: gold.location_neutral(gold.location(silver(s, f))),
        "gold_vendor": gold_vendor,
        "gold_payment": gold_payment,
        "gold_time_series": with_rows(gold.time_series, silver),
        "gold_route": gold_route,
        "gold_financial": gold_financial,
        # over gold tables
        "vendor_rollup": with_rows(rollups.vendor_rollup, gold_table("vendor")),
        "hour_profile": with_rows(rollups.hour_profile, gold_table("hourly")),
        "weekend_daily": with_rows(rollups.weekend_daily, gold_table("daily")),
        "top_revenue_days": with_rows(rollups.top_revenue_days, gold_table("daily")),
        "top_profitable_routes": with_rows(rollups.top_profitable_routes, gold_table("route")),
        "monthly_growth": with_rows(rollups.monthly_growth, gold_table("financial")),
        "gold_consistency": lambda s, f: rollups.gold_consistency(gold_table("daily")(s, f), silver(s, f)),
        "gold_validation": gold_validation,
        "view_kpi_dashboard": lambda s, f: text_times(
            view("gold.kpi_dashboard", tables.stamped(gold_table("daily")(s, f), as_of=datetime(2024, 1, 1)))
        ),
        "view_hourly_trends": lambda s, f: view("gold.hourly_trends", gold_table("hourly")(s, f)),
        "view_vendor_dashboard": lambda s, f: view("gold.vendor_dashboard", gold_table("vendor")(s, f)),
        # month loads, and the logs they wrote
        "month_load_log": month_load_log,
        "month_load_daily": month_loads.gold_rows("daily"),
        "month_load_hourly": month_loads.gold_rows("hourly"),
        "unreadable_values": month_loads.unreadable,
        "widened_column": month_loads.widened,
        "table_statistics": month_loads.statistics,
        "compacted_partitions": month_loads.compacted,
        "event_report": lambda s, f: monitoring.event_report(month_loads.events(s, f)),
        "view_run_monitoring": lambda s, f: text_times(view("control.pipeline_monitoring", run_log(s, f))),
        "view_quality_metrics": lambda s, f: _day_text(view("control.quality_metrics", run_log(s, f))),
        "latest_runs": lambda s, f: text_times(monitoring.latest_runs(run_log(s, f))),
        "health_check": health(12),
        "health_check_stale": health(50),
        "backfill_summary": backfill_summary,
        # analyses
        "peak_hours": with_rows(insights.peak_hours, gold_table("hourly")),
        "vendor_share_total": lambda s, f: insights.vendor_share_total(silver(s, f)),
        "top_pickups_ranked": with_rows(insights.top_pickups_ranked, silver),
        "payment_mix": lambda s, f: insights.payment_mix(silver(s, f)),
        "tip_by_daypart": with_rows(insights.tip_by_daypart, silver),
        "tip_by_distance": with_rows(insights.tip_by_distance, silver),
        "by_day_of_week": with_rows(insights.by_day_of_week, silver),
        "anomalous_days": with_rows(insights.anomalous_days, gold_table("daily")),
        "growth_projection": with_rows(insights.growth_projection, gold_table("financial")),
        "monthly_alerts": with_rows(insights.monthly_alerts, silver),
        "weekly_variation": with_rows(insights.weekly_variation, silver),
        "monthly_distance_growth": with_rows(insights.monthly_distance_growth, gold_table("financial")),
        "efficiency_metrics": with_rows(insights.efficiency_metrics, silver),
    }


def _day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("execution_date", calendar.date_text("execution_date"))


def _comparable(query: Query) -> Query:
    return lambda spark, folder: rounded(query(spark, folder))


QUERIES: dict[str, Query] = {name: _comparable(query) for name, query in _queries().items()}
