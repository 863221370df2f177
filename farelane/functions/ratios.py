"""Divisions that give NULL instead of failing on a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    return F.try_divide(_col(numerator), _col(denominator))


def percent(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(numerator, denominator) * F.lit(100.0)


def growth(value: str, previous: Column) -> Column:
    """Relative change against ``previous`` in percent."""
    return percent(F.col(value) - previous, previous)


def previous(value: str, key: str, order: WindowSpec, step: Column) -> Column:
    """``value`` of the row before, if its ``key`` is ``step`` (the key one period earlier); else NULL.

    With a month or week absent there is nothing to compare with, so growth over the gap is unknown.
    """
    return F.when(F.lag(key).over(order) == step, F.lag(value).over(order))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` for positive denominators, else 0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
