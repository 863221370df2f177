"""The eight gold tables over silver trips.

Every builder groups on the smallest key that determines the others and derives
labels such as day names after the aggregation, on the few result rows. Results
carry no order: sort where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.functions import calendar
from farelane.functions.partials import (
    TRIPS,
    merged_avg,
    merged_count,
    merged_sum,
    merged_trips,
    partial,
    remerged,
)
from farelane.functions.ratios import growth, percent, previous, ratio
from farelane.model import CASH, CREDIT_CARD, PICKUP

# Fixed value: the constant the cyclical features are defined with.
PI = 3.14159


def _day() -> Column:
    """Pickup day as a date: a four-byte key, cheaper to group by than its text."""
    return F.to_date(PICKUP)


def _calendar(day: str = "day") -> dict[str, Column]:
    day_of_week = F.dayofweek(day)
    return {
        "trip_date": calendar.date_text(day),
        "pickup_year": F.year(day),
        "pickup_month": F.month(day),
        "pickup_day": F.dayofmonth(day),
        "pickup_dayname": calendar.day_name(day_of_week),
        "is_weekend": calendar.is_weekend(day_of_week),
    }


#: What the day, hour and vendor parts sum up for the tables made from them.
SUMMED = (
    "total_amount",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "extra",
    "tip_percentage",
    "trip_distance",
    "trip_duration_minutes",
    "avg_speed_mph",
    "passenger_count",
)


def day_parts(flagged: DataFrame) -> DataFrame:
    """Sums per day, hour and vendor: what the daily, time series and financial tables share."""
    return flagged.groupBy(_day().alias("day"), "pickup_hour", "VendorID").agg(
        *partial(SUMMED, {"trips_with_outliers": F.col("has_outlier")})
    )


def daily(flagged: DataFrame) -> DataFrame:
    """Daily key figures. Needs the outlier flag."""
    return daily_from(day_parts(flagged))


def daily_from(parts: DataFrame) -> DataFrame:
    """The daily table from ``day_parts``. Grouping by vendor first turns the distinct vendor count into a row count."""
    hour = F.col("pickup_hour")
    periods = {f"{p.lower()}_trips": calendar.in_period(hour, p) for p in (*calendar.PERIODS, calendar.NIGHT)}
    in_period = [F.sum(F.when(test, F.col(TRIPS)).otherwise(0)).alias(name) for name, test in periods.items()]
    by_vendor = parts.groupBy("day", "VendorID").agg(*remerged(parts, "day", "pickup_hour", "VendorID"), *in_period)
    days = by_vendor.groupBy("day").agg(
        merged_trips().alias("total_trips"),
        F.count("VendorID").alias("active_vendors"),
        merged_sum("total_amount").alias("total_revenue"),
        merged_sum("fare_amount").alias("total_fare"),
        merged_sum("tip_amount").alias("total_tips"),
        merged_sum("tolls_amount").alias("total_tolls"),
        merged_avg("total_amount").alias("avg_total_amount"),
        merged_avg("fare_amount").alias("avg_fare_amount"),
        merged_avg("tip_amount").alias("avg_tip_amount"),
        merged_avg("tip_percentage").alias("avg_tip_percentage"),
        merged_sum("trip_distance").alias("total_distance"),
        merged_avg("trip_distance").alias("avg_trip_distance"),
        merged_sum("trip_duration_minutes").alias("total_duration_minutes"),
        merged_avg("trip_duration_minutes").alias("avg_trip_duration"),
        merged_avg("avg_speed_mph").alias("avg_speed"),
        merged_sum("passenger_count").alias("total_passengers"),
        merged_avg("passenger_count").alias("avg_passengers_per_trip"),
        *[merged_count(name).alias(name) for name in ("trips_with_outliers", *periods)],
    )
    derived = {
        "revenue_per_mile": ratio("total_revenue", "total_distance"),
        "outlier_percentage": percent("trips_with_outliers", "total_trips"),
    }
    return days.select(*_labelled(_calendar()), *days.columns[1:], *_labelled(derived))


def daily_basic(trips: DataFrame) -> DataFrame:
    """The daily figures that need no flags."""
    days = trips.groupBy(_day().alias("day")).agg(
        F.count("*").alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_total_amount"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("trip_duration_minutes").alias("avg_trip_duration"),
        F.avg("tip_percentage").alias("avg_tip_percentage"),
        F.sum("passenger_count").alias("total_passengers"),
    )
    keys = {name: column for name, column in _calendar().items() if name != "pickup_dayname"}
    return days.select(*_labelled(keys), *days.columns[1:])


def hourly(trips: DataFrame) -> DataFrame:
    """Figures per day and hour, with the number of locations served.

    The distinct counts stay exact distinct aggregates: their map-side partial
    result is bounded by hours times locations.
    """
    hours = trips.groupBy(_day().alias("day"), "pickup_hour").agg(
        F.count("*").alias("total_trips"),
        F.avg("total_amount").alias("avg_revenue_per_trip"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.avg("tip_percentage").alias("avg_tip_percentage"),
        F.avg("avg_speed_mph").alias("avg_speed"),
        F.count_distinct("PULocationID").alias("unique_pickup_locations"),
        F.count_distinct("DOLocationID").alias("unique_dropoff_locations"),
    )
    parts = _calendar()
    keys = {name: parts[name] for name in ("pickup_dayname", "is_weekend", "trip_date")}
    return hours.select("pickup_hour", *_labelled(keys), *hours.columns[2:])


def hourly_basic(trips: DataFrame) -> DataFrame:
    """The hourly figures without distinct counts, tips and speed."""
    hours = trips.groupBy(_day().alias("day"), "pickup_hour").agg(
        F.count("*").alias("total_trips"),
        F.avg("total_amount").alias("avg_revenue_per_trip"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    )
    parts = _calendar()
    keys = {name: parts[name] for name in ("is_weekend", "trip_date")}
    return hours.select("pickup_hour", *_labelled(keys), *hours.columns[2:])


def location(trips: DataFrame) -> DataFrame:
    """Pickup side and dropoff side of every location.

    Both sides and their distinct counterpart counts come from one grouping by
    route; the trips are read and shuffled once.
    """
    return location_from(
        trips.groupBy("PULocationID", "DOLocationID").agg(*partial(("trip_distance", "total_amount", "tip_percentage")))
    )


def location_from(routes: DataFrame) -> DataFrame:
    """The location table from ``route_parts``."""
    ends = routes.select(
        "*",
        F.inline(
            F.array(
                _end("PULocationID", "DOLocationID", "pickup"),
                _end("DOLocationID", "PULocationID", "dropoff"),
            )
        ),
    )
    return (
        ends.groupBy("location_id", "location_type")
        .agg(
            merged_trips().alias("pickup_count"),
            merged_avg("trip_distance").alias("avg_distance_from_location"),
            merged_avg("total_amount").alias("avg_revenue_from_location"),
            merged_avg("tip_percentage").alias("avg_tip_from_location"),
            F.count("counterpart").alias("unique_destinations"),
        )
        .select(
            "location_id",
            "pickup_count",
            "avg_distance_from_location",
            "avg_revenue_from_location",
            "avg_tip_from_location",
            "unique_destinations",
            "location_type",
        )
    )


def _end(location_id: str, counterpart: str, location_type: str) -> Column:
    return F.struct(
        F.col(location_id).alias("location_id"),
        F.col(counterpart).alias("counterpart"),
        F.lit(location_type).alias("location_type"),
    )


def location_neutral(locations: DataFrame) -> DataFrame:
    """The location table under names that fit both sides."""
    return locations.withColumnsRenamed(
        {
            "pickup_count": "trip_count",
            "avg_distance_from_location": "avg_distance",
            "avg_revenue_from_location": "avg_revenue",
            "avg_tip_from_location": "avg_tip",
            "unique_destinations": "unique_counterparts",
        }
    )


def vendor(flagged: DataFrame) -> DataFrame:
    """Monthly vendor performance with market shares. Needs names and the flag."""
    months = flagged.groupBy("VendorID", "vendor_name", F.trunc(_day(), "month").alias("month")).agg(
        F.count("*").alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_revenue_per_trip"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg("tip_percentage").alias("avg_tip_percentage"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.avg("avg_speed_mph").alias("avg_speed"),
        F.count_if("has_outlier").alias("problematic_trips"),
        F.count_distinct("PULocationID").alias("coverage_pickup_locations"),
        F.count_distinct("DOLocationID").alias("coverage_dropoff_locations"),
        F.count_if(F.col("payment_type") == CREDIT_CARD).alias("credit_card_trips"),
        F.count_if(F.col("payment_type") == CASH).alias("cash_trips"),
    )
    month = Window.partitionBy("month")
    derived = {
        "market_share_trips": percent("total_trips", F.sum("total_trips").over(month)),
        "market_share_revenue": percent("total_revenue", F.sum("total_revenue").over(month)),
        "outlier_rate": percent("problematic_trips", "total_trips"),
        "credit_card_rate": percent("credit_card_trips", "total_trips"),
    }
    return months.select(
        "VendorID",
        "vendor_name",
        calendar.month_text("month").alias("month_year"),
        *months.columns[3:],
        *_labelled(derived),
    )


def payment(trips: DataFrame) -> DataFrame:
    """Payment habits per weekday and period. Needs the payment description."""
    groups = trips.groupBy("payment_type", "payment_type_desc", "pickup_dayofweek", "time_period").agg(
        F.count("*").alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_amount"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg("tip_percentage").alias("avg_tip_percentage"),
        F.avg("fare_amount").alias("avg_fare"),
        F.stddev("tip_percentage").alias("tip_percentage_std"),
    )
    # The window has no partition key, but its input is the aggregate: 28 rows
    # per payment code. A second aggregate for the total would scan the trips twice.
    total = F.sum("total_revenue").over(Window.partitionBy())
    return groups.select(
        "payment_type",
        "payment_type_desc",
        calendar.day_name(F.col("pickup_dayofweek")).alias("pickup_dayname"),
        "time_period",
        *groups.columns[4:],
        percent("total_revenue", total).alias("revenue_share"),
    )


def time_series(trips: DataFrame) -> DataFrame:
    """Hourly series with cyclical features; hours without trips are absent."""
    hours = trips.groupBy(_day().alias("day"), "pickup_hour").agg(
        *partial(("total_amount", "trip_distance", "trip_duration_minutes"))
    )
    return time_series_from(hours)


def time_series_from(parts: DataFrame) -> DataFrame:
    """The time series from ``day_parts`` or any finer parts with its sums."""
    hours = parts.groupBy("day", "pickup_hour").agg(
        merged_trips().alias("trips_count"),
        merged_sum("total_amount").alias("revenue"),
        merged_avg("trip_distance").alias("avg_distance"),
        merged_avg("trip_duration_minutes").alias("avg_duration"),
    )
    day_of_week = F.dayofweek("day")
    keys = {
        "datetime_hour": F.format_string("%s %02d:00:00", calendar.date_text("day"), "pickup_hour"),
        "hour_of_day": F.col("pickup_hour"),
        "day_of_week": day_of_week,
        "is_weekend": calendar.is_weekend(day_of_week),
    }

    def angle(value: Column, cycle: int) -> Column:
        return value * F.lit(2) * F.lit(PI) / F.lit(cycle)

    features = {
        "hour_sin": F.sin(angle(F.col("pickup_hour"), 24)),
        "hour_cos": F.cos(angle(F.col("pickup_hour"), 24)),
        "day_sin": F.sin(angle(day_of_week, 7)),
        "day_cos": F.cos(angle(day_of_week, 7)),
    }
    return hours.select(*_labelled(keys), *hours.columns[2:], *_labelled(features))


def route_parts(trips: DataFrame) -> DataFrame:
    """Sums per origin and destination: what the route and location tables share."""
    hour = F.col("pickup_hour")
    counted = {
        "weekend_trips": F.col("is_weekend"),
        "morning_trips": calendar.in_period(hour, "Morning"),
        "evening_trips": calendar.in_period(hour, "Evening"),
    }
    summed = ("total_amount", "trip_distance", "trip_duration_minutes", "avg_speed_mph", "tip_percentage")
    return trips.groupBy("PULocationID", "DOLocationID").agg(
        *partial(summed, counted), F.stddev("total_amount").alias("revenue_std")
    )


def route(trips: DataFrame) -> DataFrame:
    """Figures per origin and destination."""
    return route_from(route_parts(trips))


def route_from(parts: DataFrame) -> DataFrame:
    """The route table from ``route_parts``, which has one row per route.

    ``revenue_per_mile`` divides the route's total revenue by its mean distance;
    this is the published definition.
    """

    def mean(column: str) -> Column:
        return ratio(F.col(f"{column} sum"), F.col(f"{column} count"))

    routes = parts.select(
        "PULocationID",
        "DOLocationID",
        F.col(TRIPS).alias("trip_count"),
        F.col("total_amount sum").alias("total_revenue"),
        mean("total_amount").alias("avg_revenue_per_trip"),
        mean("trip_distance").alias("avg_distance"),
        mean("trip_duration_minutes").alias("avg_duration"),
        mean("avg_speed_mph").alias("avg_speed"),
        mean("tip_percentage").alias("avg_tip_percentage"),
        "revenue_std",
        "weekend_trips",
        "morning_trips",
        "evening_trips",
    )
    return routes.withColumns(
        {
            "weekend_ratio": percent("weekend_trips", "trip_count"),
            "revenue_per_mile": ratio("total_revenue", "avg_distance"),
            "route_efficiency_score": ratio(F.col("avg_speed") * F.col("avg_tip_percentage"), "avg_duration"),
        }
    )


def financial(trips: DataFrame) -> DataFrame:
    """Monthly financial summary with growth against the previous month.

    Days are grouped first, which makes the active-day count a row count. The
    growth window has no partition key; its input is one row per month.
    """
    summed = tuple(c for c in SUMMED if c != "avg_speed_mph")
    return financial_from(trips.groupBy(_day().alias("day")).agg(*partial(summed)))


def financial_from(parts: DataFrame) -> DataFrame:
    """The financial table from ``day_parts`` or any parts by day with its sums."""
    keys = [c for c in ("day", "pickup_hour", "VendorID") if c in parts.columns]
    days = parts.groupBy("day").agg(*remerged(parts, *keys))
    months = days.groupBy(F.trunc("day", "month").alias("month")).agg(
        merged_trips().alias("total_trips"),
        F.count("day").alias("active_days"),
        merged_sum("total_amount").alias("gross_revenue"),
        merged_sum("fare_amount").alias("fare_revenue"),
        merged_sum("tip_amount").alias("tip_revenue"),
        merged_sum("tolls_amount").alias("tolls_revenue"),
        merged_sum("extra").alias("extra_revenue"),
        merged_sum("trip_distance").alias("total_miles"),
        (merged_sum("trip_duration_minutes") / F.lit(60.0)).alias("total_hours"),
        merged_sum("passenger_count").alias("total_passengers"),
        merged_avg("total_amount").alias("avg_revenue_per_trip"),
        merged_avg("trip_distance").alias("avg_miles_per_trip"),
        merged_avg("tip_percentage").alias("avg_tip_rate"),
    )
    order = Window.orderBy("month")
    before = lambda value: previous(value, "month", order, F.add_months("month", -1))
    derived = {
        "revenue_per_mile": ratio("gross_revenue", "total_miles"),
        "trips_per_day": ratio("total_trips", "active_days"),
        "revenue_per_day": ratio("gross_revenue", "active_days"),
        "revenue_growth_rate": growth("gross_revenue", before("gross_revenue")),
        "trips_growth_rate": growth("total_trips", before("total_trips")),
    }
    return months.select(
        F.year("month").alias("pickup_year"),
        F.month("month").alias("pickup_month"),
        calendar.month_text("month").alias("month_year"),
        *months.columns[1:],
        *_labelled(derived),
    )


def _labelled(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]
