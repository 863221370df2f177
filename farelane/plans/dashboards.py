"""Dashboard views, each defined once: over a frame here, over its table in the catalog.

Fixed values: view names and their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from farelane.model import GOLD, RUN_LOG

#: View name -> (table it reads, query over ``{source}``).
VIEWS = {
    "gold.kpi_dashboard": (
        GOLD["daily"],
        """SELECT trip_date, pickup_dayname, is_weekend, total_trips, total_revenue, avg_fare_amount, avg_tip_percentage,
             avg_trip_distance, avg_trip_duration, revenue_per_mile, processing_timestamp
           FROM {source} ORDER BY trip_date""",
    ),
    "gold.hourly_trends": (
        GOLD["hourly"],
        """SELECT pickup_hour, pickup_dayname, is_weekend, avg(total_trips) AS avg_trips,
             avg(avg_revenue_per_trip) AS avg_revenue, avg(avg_tip_percentage) AS avg_tip_pct
           FROM {source} GROUP BY pickup_hour, pickup_dayname, is_weekend ORDER BY pickup_hour, pickup_dayname""",
    ),
    "gold.vendor_dashboard": (
        GOLD["vendor"],
        """SELECT vendor_name, month_year, total_trips, total_revenue, market_share_trips, market_share_revenue,
             avg_tip_percentage, outlier_rate
           FROM {source} ORDER BY month_year, total_revenue DESC""",
    ),
    "control.pipeline_monitoring": (
        RUN_LOG,
        """SELECT execution_id, pipeline_name, start_time, end_time, status, stage, records_processed,
             execution_time_minutes, quality_score, error_message,
             if(status IN ('SUCCESS', 'FAILED'), status, 'PENDING') AS status_icon
           FROM {source} ORDER BY start_time DESC""",
    ),
    "control.quality_metrics": (
        RUN_LOG,
        """SELECT to_date(start_time) AS execution_date, count(*) AS total_executions,
             count_if(status = 'SUCCESS') AS successful_executions, count_if(status = 'FAILED') AS failed_executions,
             avg(quality_score) AS avg_quality_score, avg(execution_time_minutes) AS avg_execution_time,
             sum(records_processed) AS total_records_processed
           FROM {source} GROUP BY to_date(start_time) ORDER BY execution_date DESC""",
    ),
}


def view(name: str, source: DataFrame) -> DataFrame:
    """The view ``name`` over any frame with the columns of its table."""
    return source.sparkSession.sql(VIEWS[name][1], source=source)
