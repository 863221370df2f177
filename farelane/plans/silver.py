"""The silver layer: valid trips with derived columns, descriptions and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.ratios import percent
from farelane.model import CANONICAL, OUTLIER_COLUMNS, RuleSet
from farelane.operators.derive import add_derived_columns
from farelane.operators.enrich import add_business_mappings
from farelane.operators.filters import keep_valid, meets
from farelane.operators.outliers import flag_by_bounds, flag_outliers, outlier_bounds


def valid_trips(bronze: DataFrame, rules: RuleSet = CANONICAL) -> DataFrame:
    """Filter first, then derive: both are narrow and need no other table."""
    return add_derived_columns(keep_valid(bronze, rules))


#: Outlier bounds are those of a load month, in a month load and in the batch build alike.
SCOPE = ("ingestion_month",)


def flagged_trips(bronze: DataFrame, rules: RuleSet = CANONICAL, method: str = "exact", by: Sequence[str] = ()) -> DataFrame:
    return flag_outliers(valid_trips(bronze, rules), method=method, by=by)


def month_bounds(bronze: DataFrame, rules: RuleSet = CANONICAL, method: str = "exact") -> DataFrame:
    """Quartiles and outlier bounds of the valid trips, per load month and column."""
    return outlier_bounds(valid_trips(bronze, rules), method=method, by=SCOPE)


def silver(bronze: DataFrame, bounds: DataFrame | None = None, rules: RuleSet = CANONICAL, version: str = "1.0") -> DataFrame:
    """All silver columns: raw, derived, descriptions, flags by the ``bounds`` of the load month (searched if not given), and two stamps."""
    valid = valid_trips(bronze, rules)
    if bounds is None:
        bounds = month_bounds(bronze, rules)
    described = add_business_mappings(flag_by_bounds(valid, bounds, OUTLIER_COLUMNS, SCOPE))
    flags = [c for c in described.columns if c.endswith("_outlier")]
    descriptions = described.columns[-3:]
    return described.select(*valid.columns, *descriptions, *flags).withColumns(
        {
            "silver_processing_timestamp": F.current_timestamp(),
            "silver_processing_version": F.lit(version),
        }
    )


def cleaning_rate(bronze: DataFrame, rules: RuleSet = CANONICAL) -> DataFrame:
    """One row: raw and silver rows, removed rows and both rates. One scan."""
    counts = bronze.agg(
        F.count("*").alias("bronze_records"), F.count_if(meets(rules)).alias("silver_records")
    ).withColumn("removed_records", F.col("bronze_records") - F.col("silver_records"))
    return counts.withColumns(
        {
            "removed_percentage": percent("removed_records", "bronze_records"),
            "quality_rate": percent("silver_records", "bronze_records"),
        }
    )


def kept(rules: RuleSet = CANONICAL) -> Column:
    """The filter as a never-null flag, for counting instead of dropping rows."""
    return F.coalesce(meets(rules), F.lit(False))
