"""Derivations, filters, code lists and flags on hand-checked rows."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from conftest import trip
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelane.model import CANONICAL, LENIENT, OUTLIER_COLUMNS, TRIP_SCHEMA, WITHOUT_SPEED
from farelane.operators import derive, enrich, filters, outliers, quality
from farelane.plans import silver


def row(df, number):
    return df.where(F.col("row") == number).first()


def kept_rows(df, rules):
    return {r.row for r in filters.keep_valid(df, rules).select("row").collect()}


def test_filters_keep_the_expected_rows(edge):
    canonical = {1, 2, 6, 8, 10, 11, 14, 16}
    assert kept_rows(edge, CANONICAL) == canonical
    assert kept_rows(edge, WITHOUT_SPEED) == canonical | {12}
    assert kept_rows(edge, LENIENT) == canonical | {7, 13}


def test_filter_is_idempotent(edge):
    once = filters.keep_valid(edge)
    assert filters.keep_valid(once).count() == once.count()


def test_filter_report(edge):
    kept, report = filters.filter_with_report(edge)
    assert kept.columns == edge.columns
    assert report.first().asDict() == {
        "original_records": 16,
        "filtered_records": 9,
        "removed_records": 7,
        "removal_rate": 43.75,
        "quality_score": 0.5625,
    }
    assert filters.filter_report(edge.limit(0)).first().quality_score == 0


def test_derived_columns(edge):
    df = derive.add_derived_columns(edge)
    first = row(df, 1)
    assert (first.trip_duration_minutes, first.avg_speed_mph, first.tip_percentage) == (30, 10, 20)
    assert (first.time_period, first.is_weekend, first.pickup_dayname, first.pickup_dayofweek) == (
        "Morning",
        False,
        "Monday",
        2,
    )
    second = row(df, 2)
    assert (second.trip_duration_minutes, second.avg_speed_mph, second.tip_percentage) == (20, 6, 0)
    assert (second.time_period, second.is_weekend, second.pickup_dayname) == ("Night", True, "Sunday")
    assert (row(df, 3).trip_duration_minutes, row(df, 3).avg_speed_mph) == (0, 0)
    assert (row(df, 4).trip_duration_minutes, row(df, 4).avg_speed_mph) == (-30, 0)
    assert row(df, 5).trip_duration_minutes == pytest.approx(59 / 60)
    assert row(df, 6).avg_speed_mph == 60


def test_trip_metrics(edge):
    df = derive.add_trip_metrics(edge)
    assert row(df, 1).cost_per_mile == pytest.approx(5.06)
    assert row(df, 1).revenue_per_minute == pytest.approx(25.3 / 30)
    eighth = row(df, 8)
    assert (eighth.avg_speed_mph, eighth.tip_percentage, eighth.cost_per_mile) == (0, 0, 0)


def test_period_and_business_hour_boundaries(spark):
    hours = spark.range(24).select(
        F.make_timestamp(F.lit(2023), F.lit(1), F.lit(2), F.col("id").cast("int"), F.lit(0), F.lit(0)).alias("t")
    )
    found = {r.pickup_hour: r for r in derive.add_temporal_features(hours, "t").collect()}
    periods = {5: "Night", 6: "Morning", 11: "Morning", 12: "Afternoon", 17: "Afternoon", 18: "Evening", 21: "Evening", 22: "Night"}
    assert {h: found[h].time_period for h in periods} == periods
    assert [found[h].is_business_hour for h in (8, 9, 17, 18)] == [False, True, True, False]


def test_code_lists(edge):
    df = enrich.add_business_mappings(edge)
    assert df.columns == edge.columns + ["vendor_name", "rate_code_desc", "payment_type_desc"]
    assert df.count() == 16
    first, ninth, tenth = row(df, 1), row(df, 9), row(df, 10)
    assert (first.vendor_name, first.rate_code_desc, first.payment_type_desc) == (
        "Creative Mobile Technologies",
        "Standard rate",
        "Credit card",
    )
    assert ninth.vendor_name is None
    assert (tenth.rate_code_desc, tenth.payment_type_desc) == (None, None)


def test_code_lists_are_broadcast(edge):
    plan = enrich.add_business_mappings(edge)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in plan


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-50, 50), st.floats(-1e9, 1e9)), min_size=1, max_size=60),
    buckets=st.sampled_from([2, 7, 64]),
)
def test_exact_quantiles_match_spark(spark, values, buckets):
    rows = [(None if v is None else float(v),) for v in values]
    df = spark.createDataFrame(rows, "x double")
    expected = df.agg(F.percentile("x", [0.25, 0.75]).alias("p")).first().p
    found = outliers.exact_quantiles(df, ["x"], buckets=buckets)["x"]
    assert found == pytest.approx(expected) if expected else found == [None, None]


def test_exact_quantiles_with_one_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") / 10.0).alias("x"))
    expected = df.agg(F.percentile("x", [0.25, 0.75]).alias("p")).first().p
    assert outliers.exact_quantiles(df, ["x"], buckets=16)["x"] == pytest.approx(expected)


def test_approximate_quartiles_stay_within_rank_error(spark):
    values = list(range(5000))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    bounds = outliers.outlier_bounds(df, ["x"], method="approximate").first()
    assert abs(bounds.q1 - 1250) <= 50 + 1
    assert abs(bounds.q3 - 3750) <= 50 + 1


@pytest.mark.parametrize("method", ["exact", "approximate"])
def test_outlier_flags(spark, method):
    values = [10.0] * 5 + [11.0] * 5 + [12.0] * 5 + [13.0] * 5 + [100.0, None]
    df = spark.createDataFrame([(v,) for v in values], "fare_amount double")
    flagged = outliers.flag_outliers(df, ["fare_amount", "absent"], method=method)
    assert flagged.columns == ["fare_amount", "fare_amount_outlier", "has_outlier"]
    hits = flagged.where("has_outlier").collect()
    assert [r.fare_amount for r in hits] == [100.0]
    assert flagged.where("fare_amount_outlier is null").count() == 0


@pytest.mark.parametrize("method", ["exact", "approximate"])
def test_flags_exist_on_empty_input(edge, method):
    empty = silver.valid_trips(edge).where("row < 0")
    flagged = outliers.flag_outliers(empty, method=method)
    assert {f"{c}_outlier" for c in OUTLIER_COLUMNS} <= set(flagged.columns)
    assert flagged.count() == 0


def test_silver_columns(edge):
    bronze = edge.drop("row").withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_file": F.lit("f"), "ingestion_month": F.lit("2023-01")}
    )
    df = silver.silver(bronze)
    assert len(df.columns) == 43
    assert df.columns[:19] == TRIP_SCHEMA.names
    assert df.columns[-3:] == ["has_outlier", "silver_processing_timestamp", "silver_processing_version"]
    assert df.count() == 8


def test_quality_metrics(edge):
    rows = edge.drop("row")
    metrics = quality.quality_metrics(rows, datetime(2023, 1, 2, 9)).first()
    assert metrics.total_records == 16
    assert metrics.duplicate_records == 1
    assert metrics.zero_distance_trips == 1
    assert metrics.negative_amounts == 0
    assert metrics.future_trips == 1
    assert metrics.quality_score == pytest.approx(1 - 2 / 16)
    assert quality.duplicate_count(rows).first().asDict() == {"total_records": 16, "duplicate_records": 1}
    assert quality.quality_metrics(rows.limit(0), datetime(2023, 1, 1)).first().total_records == 0


def test_repeated_rows(spark):
    """Nulls in different columns differ; a hot row is counted in full; both ways agree."""
    rows = [(None, 1), (1, None), (2, 2), (2, 2), (None, None), (None, None), (3, 4)] + [(7, 7)] * 500
    df = spark.createDataFrame(rows, "a int, b int")
    found = {(r.a, r.b): r.copies for r in quality.repeated_rows(df).collect()}
    assert found == {(2, 2): 2, (None, None): 2, (7, 7): 500}


def test_bounds_are_read_once(edge):
    """All uses of the approximate quartiles share one subquery, so two scans in total."""
    flagged = outliers.flag_outliers(silver.valid_trips(edge), method="approximate")
    flagged.collect()
    plan = flagged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("percentile_approx(") - plan.count("partial_percentile_approx(") <= len(OUTLIER_COLUMNS)


def test_infinite_values_rank_last(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in [-inf, 1.0, 2.0, 3.0, 4.0, inf, inf, None, float("nan")]], "x double")
    found = outliers.exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.75, 1.0))
    assert found == {"x": [-inf, 1.5, 3.0, inf, inf]}


def test_distinct_counts_without_row_expansion(spark, edge):
    from farelane.plans import rollups

    valid = silver.valid_trips(edge)
    for df in (rollups.kpi_overall(valid), quality.summary_statistics(edge), rollups.kpi_overall(valid.where("false"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Expand " in line], plan
        assert plan.count("InMemoryTableScan") <= 1
        df.collect()
    row = rollups.kpi_overall(valid).first()
    assert (row.total_trips, row.unique_pickup_locations, row.unique_dropoff_locations) == (8, 2, 2)


def test_growth_needs_the_period_before(spark):
    from pyspark.sql import Window

    from farelane.functions.ratios import previous

    rows = spark.createDataFrame([("2023-01-01", 1), ("2023-02-01", 2), ("2023-04-01", 3)], "m string, n int").select(F.to_date("m").alias("m"), "n")
    got = rows.select("n", previous("n", "m", Window.orderBy("m"), F.add_months("m", -1)).alias("b")).orderBy("m").collect()
    assert [r.b for r in got] == [None, 1, None]


def test_business_rules(edge):
    found = {r.rule: r for r in quality.business_rules(edge).collect()}
    assert found["valid_trip_sequence"].valid_count == 14
    assert found["credit_card_trips"].invalid_count == 2
    assert found["valid_location_ids"].valid_count == 15
    assert not found["reasonable_speed"].all_rules_passed


def test_rules_flag_without_counters(spark):
    rows = [trip(payment_type=2, tip_amount=0.0, total_amount=21.3)] * 3
    result = quality.business_rules(spark.createDataFrame(rows, TRIP_SCHEMA)).first()
    assert (result.rules_passed, result.all_rules_passed) == (True, False)


def test_schema_checks(edge):
    df = edge.drop("airport_fee").withColumn("extra", F.lit("x"))
    valid, issues = quality.validate_schema(df)
    assert not valid
    assert issues == ["missing column: airport_fee", "extra column: row"]
    found = {(r.column_name, r.issue) for r in quality.schema_issues(df).collect()}
    assert found == {("airport_fee", "missing"), ("row", "extra"), ("extra", "type")}
    assert quality.validate_schema(edge.drop("row")) == (True, [])


def test_silver_quality_score(edge):
    assert quality.silver_quality_score(filters.keep_valid(edge)).first().quality_score == pytest.approx(1 - 1 / 8)
    assert quality.silver_quality_score(edge.where("row < 0")).first().quality_score == 0


def test_text_report(edge):
    text = quality.format_report(quality.quality_report(edge.drop("row"), datetime(2023, 1, 3)), "Trips")
    assert text.startswith("Trips\n=====")
    assert "- total_records: 16\n" in text and "- quality_score: 0.938" in text
    whole = quality.text_report(edge.drop("row"), datetime(2023, 1, 3))
    assert "Period: 2023-01-01 23:50 to 2023-01-02" in whole
    assert "n/a" in quality.text_report(edge.drop("row").where("false"), datetime(2023, 1, 3))
    assert "NULL PERCENTAGE" in text
