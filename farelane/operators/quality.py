"""Quality reports. Each is one aggregation over the frame unless stated."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions import measures
from farelane.functions.partials import merged_avg, merged_sum, merged_trips, partial, with_distinct_counts
from farelane.functions.ratios import percent, ratio
from farelane.model import (
    CREDIT_CARD,
    CRITICAL_COLUMNS,
    CRITICAL_COLUMNS_WITH_LOCATIONS,
    DROPOFF,
    PICKUP,
    TRIP_SCHEMA,
    Thresholds,
)


def to_rows(one_row: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row frame into several rows of computed columns."""
    structs = [F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))


def schema_issues(df: DataFrame, expected: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """One row per column that is missing, extra, or stored in another type."""
    actual = {field.name: field.dataType for field in df.schema}
    wanted = {field.name: field.dataType for field in expected}
    issues = [(name, "missing", wanted[name].simpleString(), None) for name in wanted if name not in actual]
    issues += [(name, "extra", None, actual[name].simpleString()) for name in actual if name not in wanted]
    issues += [
        (name, "type", wanted[name].simpleString(), actual[name].simpleString())
        for name in wanted
        if name in actual and actual[name] != wanted[name]
    ]
    schema = "column_name string, issue string, expected_type string, actual_type string"
    return df.sparkSession.createDataFrame(issues, schema)


def validate_schema(df: DataFrame, expected: T.StructType = TRIP_SCHEMA) -> tuple[bool, list[str]]:
    """Whether no expected column is missing, and all missing and extra names."""
    missing = [name for name in expected.names if name not in df.columns]
    extra = [name for name in df.columns if name not in expected.names]
    return not missing, [f"missing column: {n}" for n in missing] + [f"extra column: {n}" for n in extra]


def bronze_quality(df: DataFrame, by: str = "ingestion_month") -> DataFrame:
    """Per load month: rows, nulls in the critical columns, suspicious amounts."""
    counts = df.groupBy(by).agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in CRITICAL_COLUMNS],
        F.count_if(F.col("total_amount") < 0).alias("negative_amounts"),
        F.count_if(F.col("trip_distance") == 0).alias("zero_distance_trips"),
    )
    return counts.withColumns({f"{c}_null_pct": percent(f"{c}_nulls", "total_rows") for c in CRITICAL_COLUMNS})


def repeated_rows(df: DataFrame) -> DataFrame:
    """Every full row that occurs more than once, with its number of ``copies``.

    Exact, but without grouping whole rows: 64-bit fingerprints are counted first, and only
    rows whose fingerprint occurs twice are compared in full. Equal rows have equal
    fingerprints, so none is missed; rows that merely collide fall apart in the full
    comparison. The join carries no hint: Spark broadcasts the repeated fingerprints where
    they are few. Grouping collapses copies on the map side, so one row that makes up a third
    of the table is no hot spot.
    """
    mark = _fingerprint(df)
    marks = df.groupBy(mark.alias("_mark")).agg(F.count("*").alias("n")).where("n > 1").select("_mark")
    suspects = df.withColumn("_mark", mark).join(marks, "_mark", "left_semi").drop("_mark")
    return suspects.groupBy(*df.columns).agg(F.count("*").alias("copies")).where("copies > 1")


def _fingerprint(df: DataFrame) -> Column:
    """Hash of all columns; null flags tell ``(null, 1)`` from ``(1, null)``."""
    return F.xxhash64(*df.columns, *[F.isnull(c) for c in df.columns])


def duplicate_records(df: DataFrame) -> Column:
    """How many rows repeat an earlier full row, as a scalar subquery."""
    repeats = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))
    return repeated_rows(df).agg(repeats.alias("duplicate_records")).scalar()


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows and how many of them repeat an earlier full row."""
    return df.agg(F.count("*").alias("total_records")).withColumn("duplicate_records", duplicate_records(df))


def quality_metrics(df: DataFrame, as_of: datetime | Column) -> DataFrame:
    """One row: null counts and shares, duplicates, suspicious rows and a score.

    One scan for all counts, besides the search for duplicates. Zero distance
    does not lower the score.
    """
    columns = [c for c in CRITICAL_COLUMNS_WITH_LOCATIONS if c in df.columns]
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    counts = df.agg(
        F.count("*").alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
        F.count_if(F.col("total_amount") < 0).alias("negative_amounts"),
        F.count_if(F.col("trip_distance") == 0).alias("zero_distance_trips"),
        F.count_if(F.col(PICKUP) > now).alias("future_trips"),
    ).withColumn("duplicate_records", duplicate_records(df))
    nulls = sum((F.col(f"{c}_nulls") for c in columns), F.lit(0))
    issues = nulls + F.col("duplicate_records") + F.col("negative_amounts") + F.col("future_trips")
    score = F.greatest(F.lit(0.0), F.lit(1.0) - ratio(issues, "total_records"))
    return counts.withColumns(
        {f"{c}_null_pct": percent(f"{c}_nulls", "total_records") for c in columns} | {"quality_score": score}
    )


def silver_quality_score(df: DataFrame, *by: str) -> DataFrame:
    """Null rate, rate of implausible trips, and 1 minus both (at least 0).

    One row, or one per group of ``by``.
    """
    counts = df.groupBy(*by).agg(
        F.count("*").alias("total_records"),
        sum((F.count_if(F.col(c).isNull()) for c in CRITICAL_COLUMNS), F.lit(0)).alias("null_values"),
        F.count_if(
            (F.col("total_amount") < 0)
            | (F.col("total_amount") > 1000)
            | (F.col("trip_distance") > 200)
            | (measures.speed_mph() > 150)
        ).alias("outlier_records"),
    )
    null_rate = ratio(F.col("null_values"), F.col("total_records") * len(CRITICAL_COLUMNS))
    score = F.greatest(F.lit(0.0), F.lit(1.0) - null_rate - ratio("outlier_records", "total_records"))
    return counts.withColumn("quality_score", F.coalesce(F.when(F.col("total_records") > 0, score), F.lit(0.0)))


def summary_statistics(df: DataFrame) -> DataFrame:
    """One row: period, money totals, distance and passenger totals, distinct codes."""
    names = {
        "total_amount": ("total_revenue", "avg_revenue"),
        "fare_amount": ("total_fare", "avg_fare"),
        "tip_amount": ("total_tips", "avg_tip"),
        "trip_distance": ("total_distance", "avg_distance"),
        "passenger_count": ("total_passengers", "avg_passengers"),
    }
    # Whole days between the first and the last pickup, time of day included.
    days = F.floor((F.unix_timestamp(F.max("last")) - F.unix_timestamp(F.min("first"))) / F.lit(86400.0))
    keys = {"PULocationID": "unique_pickup_locations", "DOLocationID": "unique_dropoff_locations", "VendorID": "unique_vendors"}
    groups = df.groupBy(*keys).agg(*partial(names), F.min(PICKUP).alias("first"), F.max(PICKUP).alias("last"))
    totals = [
        F.coalesce(measure(column), F.lit(0.0)).alias(alias)
        for column, aliases in names.items()
        for measure, alias in zip((merged_sum, merged_avg), aliases)
    ]
    counts = F.struct(
        F.coalesce(merged_trips(), F.lit(0)).alias("total_records"),
        F.min("first").alias("start_date"),
        F.max("last").alias("end_date"),
        F.coalesce(days, F.lit(0)).alias("days"),
        *totals,
    )
    return with_distinct_counts(groups, counts, keys)


def quality_report(df: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Long report ``(section, metric, value)`` over both summaries."""
    sections = {
        "summary": ("total_records", "quality_score"),
        "financial": ("total_revenue", "avg_revenue", "total_tips"),
        "operational": ("total_distance", "avg_distance", "total_passengers"),
        "quality": ("duplicate_records", "negative_amounts", "zero_distance_trips", "future_trips"),
        "null_percentage": tuple(c for c in CRITICAL_COLUMNS_WITH_LOCATIONS if c in df.columns),
    }
    metrics = quality_metrics(df, as_of)
    statistics = summary_statistics(df)
    parts = []
    for source in (metrics, statistics):
        rows = []
        for section, names in sections.items():
            for name in names:
                column = f"{name}_null_pct" if section == "null_percentage" else name
                if column in source.columns and not (source is statistics and column in metrics.columns):
                    value = F.col(column).cast("double")
                    rows.append({"section": F.lit(section), "metric": F.lit(name), "value": value})
        parts.append(to_rows(source, rows))
    return parts[0].unionByName(parts[1])


#: Metrics that count, and those shown with three digits; all others have two.
_WHOLE = ("total_records", "duplicate_records", "negative_amounts", "zero_distance_trips", "future_trips")
_THREE_DIGITS = ("quality_score",)


def format_report(
    report: DataFrame, title: str = "Data quality report", period: tuple[datetime | None, datetime | None] | None = None
) -> str:
    """The long report as text, with the first and last pickup if given. It has a few dozen rows at any scale."""
    lines = [title, "=" * len(title)]
    if period and None not in period:
        lines.append(f"Period: {period[0]:%Y-%m-%d %H:%M} to {period[1]:%Y-%m-%d %H:%M}")
    section = None
    for row in report.collect():
        if row.section != section:
            section = row.section
            lines += ["", section.replace("_", " ").upper()]
        digits = 0 if row.metric in _WHOLE else 3 if row.metric in _THREE_DIGITS else 2
        lines.append(f"- {row.metric}: " + ("n/a" if row.value is None else f"{row.value:,.{digits}f}"))
    return "\n".join(lines)


def text_report(df: DataFrame, as_of: datetime | Column, title: str = "Data quality report") -> str:
    """The report over ``df`` with its period, as text."""
    period = df.agg(F.min(PICKUP), F.max(PICKUP)).first()
    return format_report(quality_report(df, as_of), title, (period[0], period[1]))


def business_rules(df: DataFrame) -> DataFrame:
    """One row per rule: valid and invalid trips and the valid share.

    ``all_rules_passed`` asks more than 95 % of every line, the two credit-card
    counters included; ``rules_passed`` leaves the counters out.
    """
    parts = F.col("fare_amount") + F.col("extra") + F.col("mta_tax") + F.col("improvement_surcharge")
    credit = F.col("payment_type") == CREDIT_CARD
    tests = {
        "valid_trip_sequence": F.col(PICKUP) < F.col(DROPOFF),
        "consistent_amounts": F.col("total_amount") >= parts - F.lit(1.0),
        "credit_card_trips": credit,
        "tips_with_credit": credit & (F.col("tip_amount") > 0),
        "reasonable_speed": measures.speed_mph().between(0.5, 80.0),
        "valid_location_ids": F.col("PULocationID").between(1, 263) & F.col("DOLocationID").between(1, 263),
    }
    counters = ("credit_card_trips", "tips_with_credit")
    counts = df.agg(F.count("*").alias("total_records"), *[F.count_if(t).alias(n) for n, t in tests.items()])
    passed = {name: F.coalesce(percent(name, "total_records") > 95, F.lit(False)) for name in tests}

    def every(names) -> Column:
        result = F.lit(True)
        for name in names:
            result = result & passed[name]
        return result

    return to_rows(
        counts,
        [
            {
                "rule": F.lit(name),
                "valid_count": F.col(name),
                "invalid_count": F.col("total_records") - F.col(name),
                "valid_percentage": percent(name, "total_records"),
                "all_rules_passed": every(tests),
                "rules_passed": every(n for n in tests if n not in counters),
            }
            for name in tests
        ],
    )


def threshold_checks(
    bronze: DataFrame, flagged: DataFrame, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """One row per configured limit: measured value, limit, passed.

    ``bronze`` holds raw trips with ``ingestion_month``, ``flagged`` silver trips
    with ``has_outlier``.
    """
    months = bronze.groupBy("ingestion_month").agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in CRITICAL_COLUMNS]
    )
    raw = months.agg(
        F.min("n").cast("double").alias("min_records_per_file"),
        F.greatest(*[percent(F.sum(c), F.sum("n")) for c in CRITICAL_COLUMNS]).alias("max_null_percentage"),
    )
    days = flagged.groupBy(F.to_date(PICKUP).alias("day")).agg(
        F.count("*").alias("n"),
        F.count_if("has_outlier").alias("outliers"),
        F.sum("total_amount").alias("revenue"),
    )
    clean = days.agg(
        percent(F.sum("outliers"), F.sum("n")).alias("max_outlier_percentage"),
        F.min("revenue").alias("min_revenue_per_day"),
    )

    def check(name: str) -> dict[str, Column]:
        value, limit = F.col(name), F.lit(float(getattr(thresholds, name)))
        passed = value >= limit if name.startswith("min") else value <= limit
        return {"check_name": F.lit(name), "value": value, "limit": limit, "passed": passed}

    return to_rows(raw, [check(n) for n in raw.columns]).unionByName(to_rows(clean, [check(n) for n in clean.columns]))


def quality_indicators(bronze: DataFrame, flagged: DataFrame, kept: Column) -> DataFrame:
    """One row: quality rate, outlier share, consistency and completeness in percent."""
    parts = F.col("fare_amount") + F.col("extra") + F.col("mta_tax") + F.col("improvement_surcharge")
    raw = bronze.agg(
        percent(F.count_if(kept), F.count("*")).alias("quality_rate"),
        percent(F.count_if(F.col("total_amount") >= parts - F.lit(1.0)), F.count("*")).alias("consistency_rate"),
        (
            F.lit(100.0)
            - percent(
                sum((F.count_if(F.col(c).isNull()) for c in CRITICAL_COLUMNS_WITH_LOCATIONS), F.lit(0)),
                F.count("*") * len(CRITICAL_COLUMNS_WITH_LOCATIONS),
            )
        ).alias("completeness_rate"),
    )
    outliers = flagged.agg(percent(F.count_if("has_outlier"), F.count("*")).alias("p"))
    return raw.withColumn("outlier_rate", outliers.scalar())
