"""Reports over the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.ratios import ratio
from farelane.model import Thresholds
from farelane.plans.dashboards import view


def latest_runs(log: DataFrame, k: int = 10) -> DataFrame:
    """The last runs; the months of one load start together and rank by id."""
    return view("control.pipeline_monitoring", log).orderBy(F.desc("start_time"), F.desc("execution_id")).limit(k)


def event_report(events: DataFrame) -> DataFrame:
    """(level, message, detail, value, n_events, total) per kind of event and detail.

    Details that are numbers are added up in ``total``; of others, each ``value`` is a row. Events without details have one row.
    """
    rows = events.select("level", "message", F.explode_outer("details").alias("detail", "text"))
    number = F.col("text").try_cast("double")
    value = F.when(number.isNull(), F.col("text")).alias("value")
    return rows.groupBy("level", "message", "detail", value).agg(F.count("*").alias("n_events"), F.sum(number).alias("total"))


def health(log: DataFrame, as_of: datetime | Column, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """One row: failure rate and quality of the last seven days, age of the last run.

    ``status`` is the worst finding, so a later and milder one never hides it.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    recent = F.col("start_time") >= F.date_sub(F.to_date(now), 7)
    succeeded = F.col("status") == "SUCCESS"
    facts = log.agg(
        F.count_if(recent).alias("recent_runs"),
        F.count_if(recent & (F.col("status") == "FAILED")).alias("failed_runs"),
        F.avg(F.when(recent & succeeded, F.col("quality_score"))).alias("avg_quality_score"),
        F.max("start_time").alias("last_run"),
        F.max_by("status", "start_time").alias("last_status"),
    )
    age = (F.unix_timestamp(now) - F.unix_timestamp("last_run")) / F.lit(3600.0)
    facts = facts.withColumns({"failure_rate": ratio("failed_runs", "recent_runs"), "hours_since_last_run": age})

    def found(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    facts = facts.withColumns(
        {
            "failure_issue": found(F.col("failure_rate") > thresholds.max_failure_rate),
            "quality_issue": found(F.col("avg_quality_score") < thresholds.min_quality_score),
            "freshness_issue": found(F.col("hours_since_last_run") > thresholds.max_hours_since_last_run),
        }
    )
    status = (
        F.when(F.col("failure_issue"), "UNHEALTHY")
        .when(F.col("quality_issue") | F.col("freshness_issue"), "WARNING")
        .otherwise("HEALTHY")
    )
    return facts.withColumn("health_status", status)


def outcomes(log: DataFrame) -> DataFrame:
    """Months tried, loaded and failed, as one row."""
    return log.agg(
        F.count("*").alias("total_months"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful_months"),
        F.count_if(F.col("status") == "FAILED").alias("failed_months"),
    )
