"""Sums and counts that can be merged, so one grouping can feed a coarser one.

Where a report needs a distinct count next to sums, grouping once by the finer
key and merging replaces the row expansion Spark plans for distinct aggregates:
every trip is read once and aggregated on the map side, and only the small
partial groups are grouped again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIPS = "trips"


def partial(columns: Iterable[str], counted: dict[str, Column] | None = None) -> list[Column]:
    """Trips, sum and non-null count of each column, and conditional counts."""
    sums = [F.sum(c).alias(f"{c} sum") for c in columns]
    counts = [F.count(c).alias(f"{c} count") for c in columns]
    tests = [F.count_if(test).alias(name) for name, test in (counted or {}).items()]
    return [F.count("*").alias(TRIPS), *sums, *counts, *tests]


def remerged(parts: DataFrame, *keys: str) -> list[Column]:
    """Every partial column of ``parts`` summed under its own name, for a coarser grouping."""
    return [F.sum(c).alias(c) for c in parts.columns if c not in keys]


def merged_trips() -> Column:
    return F.sum(TRIPS)


def merged_sum(column: str) -> Column:
    return F.sum(F.col(f"{column} sum"))


def merged_avg(column: str) -> Column:
    return F.try_divide(F.sum(F.col(f"{column} sum")), F.sum(F.col(f"{column} count")))


def merged_count(name: str) -> Column:
    return F.sum(name)


def with_distinct_counts(groups: DataFrame, totals: Column, keys: dict[str, str]) -> DataFrame:
    """One row: the fields of ``totals`` over ``groups``, and the distinct values of each of ``keys``.

    ``groups`` has one row per combination of the keys. These rows, not the trips behind them, are
    repeated once per key and grouped by its values; the first repetition alone carries sums.
    Columns named ``first`` and ``last`` merge as minimum and maximum, all others as sums.
    """
    measures = [c for c in groups.columns if c not in keys]
    texts = F.array(*[F.col(key).cast("string") for key in keys])
    tagged = groups.select(*measures, F.posexplode(texts).alias("key", "value"))
    merges = {"first": F.min, "last": F.max}
    carried = [merges.get(c, F.sum)(F.when(F.col("key") == 0, F.col(c))).alias(c) for c in measures]
    values = tagged.groupBy("key", "value").agg(*carried)
    counts = [
        F.count_if((F.col("key") == i) & F.col("value").isNotNull()).alias(name) for i, name in enumerate(keys.values())
    ]
    return values.agg(totals.alias("totals"), *counts).select("totals.*", *keys.values())
