"""Gold tables, analyses and monitoring: invariants and hand-checked values."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import trip
from pyspark.sql import functions as F

from farelane.model import TRIP_SCHEMA
from farelane.plans.dashboards import view
from farelane.plans import gold, insights, monitoring, rollups, silver
from farelane.operators import enrich, outliers


@pytest.fixture(scope="module")
def trips(spark):
    """A few hundred valid trips over three months, one route holding a third of them."""
    rows = []
    for i in range(600):
        hot = i % 3 == 0
        rows.append(
            trip(
                VendorID=1 + i % 2,
                tpep_pickup_datetime=datetime(2023, 1, 1) + timedelta(hours=3 * i, minutes=i % 60),
                minutes=5 + i % 50,
                PULocationID=7 if hot else 1 + i % 11,
                DOLocationID=9 if hot else 1 + i % 13,
                payment_type=1 + i % 4,
                trip_distance=float(i % 5),
                tip_amount=float(i % 7),
                total_amount=20.0 + i % 30,
            )
        )
    bronze = spark.createDataFrame(rows, TRIP_SCHEMA)
    return enrich.add_business_mappings(silver.flagged_trips(bronze)).cache()


def test_daily_totals_match_silver(trips):
    daily = gold.daily(trips)
    sums = daily.agg(F.sum("total_trips"), F.sum("total_revenue"), F.sum("trips_with_outliers")).first()
    expected = trips.agg(F.count("*"), F.sum("total_amount"), F.count_if("has_outlier")).first()
    assert tuple(sums) == pytest.approx(tuple(expected))
    periods = F.col("morning_trips") + F.col("afternoon_trips") + F.col("evening_trips") + F.col("night_trips")
    assert daily.where(periods != F.col("total_trips")).isEmpty()
    consistency = rollups.gold_consistency(daily, trips).first()
    assert (consistency.difference, consistency.consistent) == (0, True)


def test_daily_matches_plain_distinct_aggregation(trips):
    plain = trips.groupBy(F.date_format("tpep_pickup_datetime", "yyyy-MM-dd").alias("trip_date")).agg(
        F.count_distinct("VendorID").alias("v"), F.avg("passenger_count").alias("p"), F.avg("tip_percentage").alias("t")
    )
    joined = gold.daily(trips).join(plain, "trip_date")
    assert joined.count() == plain.count()
    off = joined.where(
        (F.col("active_vendors") != F.col("v"))
        | (F.abs(F.col("avg_passengers_per_trip") - F.col("p")) > 1e-9)
        | (F.abs(F.col("avg_tip_percentage") - F.col("t")) > 1e-9)
    )
    assert off.isEmpty()


def test_location_matches_plain_distinct_aggregation(trips):
    found = {(r.location_type, r.location_id): r for r in gold.location(trips).collect()}
    for kind, key, other in (("pickup", "PULocationID", "DOLocationID"), ("dropoff", "DOLocationID", "PULocationID")):
        plain = trips.groupBy(key).agg(
            F.count("*").alias("n"), F.count_distinct(other).alias("d"), F.avg("total_amount").alias("a")
        )
        rows = plain.collect()
        assert len(rows) == sum(k[0] == kind for k in found)
        for row in rows:
            match = found[kind, row[key]]
            assert (match.pickup_count, match.unique_destinations) == (row.n, row.d)
            assert match.avg_revenue_from_location == pytest.approx(row.a)


def test_shares_add_up(trips):
    vendor = gold.vendor(trips)
    shares = vendor.groupBy("month_year").agg(F.sum("market_share_trips").alias("t"), F.sum("market_share_revenue").alias("r"))
    assert all(r.t == pytest.approx(100) and r.r == pytest.approx(100) for r in shares.collect())
    assert gold.payment(trips).agg(F.sum("revenue_share")).first()[0] == pytest.approx(100)
    assert insights.payment_mix(trips).agg(F.sum("pct_of_trips")).first()[0] == pytest.approx(100)


def test_financial_growth_and_days(trips):
    rows = gold.financial(trips).orderBy("month_year").collect()
    assert [r.month_year for r in rows] == ["2023-01", "2023-02", "2023-03"]
    assert [r.active_days for r in rows] == [31, 28, 16]
    assert rows[0].revenue_growth_rate is None
    assert rows[1].trips_growth_rate == pytest.approx((rows[1].total_trips / rows[0].total_trips - 1) * 100)
    projected = insights.growth_projection(gold.financial(trips), months=2).orderBy("months_ahead").collect()
    assert [r.month_year for r in projected] == ["2023-04", "2023-05"]


def test_ratios_by_zero_are_null(spark):
    rows = [trip(trip_distance=0.0, fare_amount=0.0, tip_amount=0.0, total_amount=0.0)]
    flagged = silver.flagged_trips(spark.createDataFrame(rows, TRIP_SCHEMA))
    assert gold.daily(flagged).first().revenue_per_mile is None
    assert gold.route(flagged).first().revenue_per_mile is None
    assert gold.financial(flagged).first().revenue_per_mile is None


def test_distinct_trips_are_scanned_once(trips):
    """Two sides of the location table share one aggregation of the trips."""
    plan = gold.location(trips)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 1
    assert "Expand" not in gold.daily(trips)._jdf.queryExecution().executedPlan().toString()


def test_top_lists_break_ties_by_id(trips):
    routes = rollups.top_routes_by_count(trips, 3).collect()
    assert (routes[0].PULocationID, routes[0].DOLocationID) == (7, 9)
    counts = [(-r.trip_count, r.PULocationID, r.DOLocationID) for r in routes]
    assert counts == sorted(counts)
    ranked = insights.top_pickups_ranked(trips, 4).collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4]


def test_outlier_summary_counts_flags(trips):
    summary = outliers.outlier_summary(trips).first()
    assert summary.total_records == trips.count()
    assert summary.outlier_records == trips.where("has_outlier").count()


AS_OF = datetime(2024, 1, 31, 12)


def run(hours_ago: float, status: str = "SUCCESS", quality: float | None = 0.9) -> tuple:
    start = AS_OF - timedelta(hours=hours_ago)
    stage = "COMPLETED" if status == "SUCCESS" else "SILVER"
    return (f"exec_{hours_ago}", "trips", start, start + timedelta(minutes=5), status, stage, 10, 5.0, quality, None)


LOG = (
    "execution_id string, pipeline_name string, start_time timestamp, end_time timestamp, status string, stage string,"
    " records_processed bigint, execution_time_minutes double, quality_score double, error_message string"
)
RUNS = [
    run(50, quality=0.95),
    run(72, quality=0.9),
    run(96, quality=0.7),
    run(100, "FAILED", None),
    run(240),
    run(241),
    run(480, "FAILED", None),
]


def test_health(spark):
    found = monitoring.health(spark.createDataFrame(RUNS, LOG), AS_OF).first()
    assert (found.recent_runs, found.failed_runs, found.failure_rate) == (4, 1, 0.25)
    assert found.avg_quality_score == pytest.approx(0.85)
    assert (found.failure_issue, found.quality_issue, found.freshness_issue) == (True, False, True)
    assert found.health_status == "UNHEALTHY"
    assert (found.last_status, found.hours_since_last_run) == ("SUCCESS", 50)


def test_health_of_good_and_empty_logs(spark):
    good = spark.createDataFrame([run(5), run(30)], LOG)
    assert monitoring.health(good, AS_OF).first().health_status == "HEALTHY"
    assert monitoring.health(good.limit(0), AS_OF).first().health_status == "HEALTHY"
    poor = spark.createDataFrame([run(5, quality=0.5)], LOG)
    assert monitoring.health(poor, AS_OF).first().health_status == "WARNING"


def test_run_reports(spark):
    log = spark.createDataFrame(RUNS + [run(1, "RUNNING", None)], LOG)
    assert view("control.pipeline_monitoring", log).first().status_icon == "PENDING"
    days = {str(r.execution_date): r for r in view("control.quality_metrics", log).collect()}
    assert days["2024-01-27"].total_executions == 2
    assert days["2024-01-27"].failed_executions == 1
    assert monitoring.latest_runs(log, 2).count() == 2
