"""Times the headline queries and prints one JSON line.

Every query runs once to warm up and three times timed; the median counts. The
``noop`` sink makes Spark compute all rows without moving them to the driver.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import tempfile
import time

from checks.inputs import bronze, silver
from checks.queries import QUERIES
from farelane.session import get_session

HEADLINES = (
    "derived_columns",
    "silver_filter",
    "business_mappings",
    "quality_metrics",
    "business_rules",
    "summary_statistics",
    "outlier_bounds",
    "outlier_flags",
    "gold_daily",
    "gold_hourly",
    "gold_location",
    "gold_vendor",
    "gold_payment",
    "gold_time_series",
    "gold_route",
    "gold_financial",
    "kpi_overall",
    "top_profitable_routes",
    "weekly_variation",
    "monthly_alerts",
    "health_check",
)
RUNS = 3


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="bench-")
    spark = get_session(
        "bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": work,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Writing the tables the queries read, once: the ingest itself.
    times = {}
    for name, layer in (("load_bronze", bronze), ("load_silver", silver)):
        start = time.perf_counter()
        layer(spark, folder)
        times[name] = round(time.perf_counter() - start, 3)
    for name in HEADLINES:
        query = QUERIES[name]
        seconds(lambda: query(spark, folder))
        times[name] = round(statistics.median(seconds(lambda: query(spark, folder)) for _ in range(RUNS)), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()
    shutil.rmtree(work, ignore_errors=True)


if __name__ == "__main__":
    main()
