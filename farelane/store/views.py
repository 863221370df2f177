"""Catalog views for dashboards."""

from __future__ import annotations

from pyspark.sql import SparkSession

from farelane.plans.dashboards import VIEWS


def create_views(spark: SparkSession, namespace: str = "") -> list[str]:
    """Create or renew every view whose table exists; returns their names."""
    made = []
    for view, (spec, query) in VIEWS.items():
        name, table = f"{namespace}{view}", spec.within(namespace).name
        if spark.catalog.tableExists(table):
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query.format(source=table)}")
            made.append(name)
    return made
