"""The run log: one row per load, partitioned by day."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from farelane.model import EVENT_LOG, RUN_LOG
from farelane.store.tables import append_rows, ensure_database

# Columns of the run log; ``run_date`` is the partition column.
RUN_COLUMNS = """
    execution_id string, pipeline_name string, start_time timestamp, end_time timestamp, status string, stage string,
    records_processed bigint, records_bronze bigint, records_silver bigint, records_gold bigint,
    execution_time_minutes double, error_message string, quality_score double, created_at timestamp, run_date date"""
EVENT_COLUMNS = """
    execution_id string, event_time timestamp, level string, message string, details map<string,string>, run_date date"""


def create_run_log(spark: SparkSession, namespace: str = "") -> None:
    ensure_database(spark, f"{namespace}{RUN_LOG.name}")
    for spec, columns in ((RUN_LOG, RUN_COLUMNS), (EVENT_LOG, EVENT_COLUMNS)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}{spec.name} ({columns}) USING parquet PARTITIONED BY (run_date)")


def read_run_log(spark: SparkSession, namespace: str = "") -> DataFrame:
    return spark.table(f"{namespace}{RUN_LOG.name}")


def read_events(spark: SparkSession, namespace: str = "") -> DataFrame:
    return spark.table(f"{namespace}{EVENT_LOG.name}")


def _utc_day(at: datetime) -> date:
    """Day of a run in UTC; times without zone are the host's."""
    return at.astimezone(timezone.utc).date()


def append_runs(spark: SparkSession, runs: list[dict], namespace: str = "") -> None:
    """Append finished runs, one row each. Counts are those of the loaded month."""
    schema = read_run_log(spark, namespace).schema
    rows = []
    for run in runs:
        counts = [run.get(f"records_{layer}") for layer in ("bronze", "silver", "gold")]
        row = run | {
            "records_processed": sum(n or 0 for n in counts),
            "execution_time_minutes": (run["end_time"] - run["start_time"]).total_seconds() / 60,
            "created_at": run["end_time"],
            "run_date": _utc_day(run["start_time"]),
        }
        rows.append(tuple(row.get(n) for n in schema.names))
    append_rows(spark.createDataFrame(rows, schema), RUN_LOG.within(namespace))


def append_events(spark: SparkSession, events: list[tuple], namespace: str = "") -> None:
    """Append ``(execution id, time, level, message, details)`` events."""
    if events:
        rows = [(run, at, level, text, details, _utc_day(at)) for run, at, level, text, details in events]
        append_rows(spark.createDataFrame(rows, EVENT_COLUMNS), EVENT_LOG.within(namespace))
