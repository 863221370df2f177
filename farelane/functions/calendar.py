"""Calendar parts of a timestamp and the labels built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English day names, 1 = Sunday as in ``dayofweek``.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
# Inclusive hour ranges; every other hour is "Night".
PERIODS = {"Morning": (6, 11), "Afternoon": (12, 17), "Evening": (18, 21)}
NIGHT = "Night"
BUSINESS_HOURS = (9, 17)


def day_name(day_of_week: Column) -> Column:
    """Locale-independent day name of a 1..7 day number."""
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), day_of_week)


def is_weekend(day_of_week: Column) -> Column:
    return F.coalesce(day_of_week.isin(1, 7), F.lit(False))


def period(hour: Column) -> Column:
    chain = F
    for label, (first, last) in PERIODS.items():
        chain = chain.when(hour.between(first, last), label)
    return chain.otherwise(NIGHT)


def in_period(hour: Column, label: str) -> Column:
    """Same test as ``period(hour) == label`` on the hour number, without the string."""
    if label == NIGHT:
        inside = [hour.between(*bounds) for bounds in PERIODS.values()]
        return F.coalesce(~(inside[0] | inside[1] | inside[2]), F.lit(True))
    return hour.between(*PERIODS[label])


def is_business_hour(hour: Column) -> Column:
    return F.coalesce(hour.between(*BUSINESS_HOURS), F.lit(False))


def date_text(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_text(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")
