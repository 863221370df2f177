"""Business analyses over silver trips and gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.functions import calendar
from farelane.functions.ratios import growth, percent, previous
from farelane.model import PICKUP
from farelane.operators.quality import to_rows


def peak_hours(hourly: DataFrame) -> DataFrame:
    """Busiest hour before noon, busiest hour after noon, and quietest hour of an average day."""
    hours = hourly.groupBy("pickup_hour").agg(F.avg("total_trips").alias("avg_trips"))
    hour, trips = F.col("pickup_hour"), F.col("avg_trips")
    # The earlier hour wins a tie.
    busy = F.struct(trips.alias("avg_trips"), (-hour).alias("order"))
    morning = F.when(hour < 12, busy)
    extremes = hours.agg(
        F.max(morning).alias("morning_peak"),
        F.max(F.when(hour >= 12, busy)).alias("evening_peak"),
        F.min(F.struct(trips.alias("avg_trips"), hour.alias("order"))).alias("trough"),
    )
    return to_rows(
        extremes,
        [
            {
                "kind": F.lit(kind),
                "pickup_hour": F.abs(F.col(kind)["order"]),
                "avg_trips": F.col(kind)["avg_trips"],
            }
            for kind in ("morning_peak", "evening_peak", "trough")
        ],
    )


def vendor_share_total(trips: DataFrame) -> DataFrame:
    """Share, mean revenue and mean tip of every vendor over the whole period."""
    vendors = trips.groupBy("VendorID", "vendor_name").agg(
        F.count("*").alias("total_trips"),
        F.avg("total_amount").alias("avg_revenue"),
        F.avg("tip_percentage").alias("avg_tip_pct"),
    )
    return vendors.withColumn("market_share", _share("total_trips"))


def top_pickups_ranked(trips: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest pickup locations with rank and share of all trips.

    The rank window sees only the k rows the top-k already picked.
    """
    counts = trips.groupBy("PULocationID").agg(F.count("*").alias("total_trips"))
    shares = counts.withColumn("pct_of_total", _share("total_trips"))
    order = (F.desc("total_trips"), F.asc("PULocationID"))
    top = shares.orderBy(*order).limit(k)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), *top.columns)


def payment_mix(trips: DataFrame) -> DataFrame:
    mix = trips.groupBy("payment_type", "payment_type_desc").agg(
        F.count("*").alias("total_trips"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg("tip_percentage").alias("avg_tip_pct"),
        F.avg("total_amount").alias("avg_revenue"),
    )
    return mix.withColumn("pct_of_trips", _share("total_trips"))


def outlier_causes(trips: DataFrame) -> DataFrame:
    """Trips per cause of an implausible record, one row per cause."""
    parts = F.col("fare_amount") + F.col("extra") + F.col("mta_tax") + F.col("improvement_surcharge")
    causes = {
        "distance_over_100_miles": F.col("trip_distance") > 100,
        "speed_over_80_mph": F.col("avg_speed_mph") > 80,
        "inconsistent_amounts": F.col("total_amount") < parts - F.lit(1.0),
    }
    counts = trips.agg(F.count("*").alias("n"), *[F.count_if(test).alias(name) for name, test in causes.items()])
    return to_rows(
        counts, [{"cause": F.lit(c), "trips": F.col(c), "pct_of_trips": percent(c, "n")} for c in causes]
    )


def tip_by_daypart(trips: DataFrame) -> DataFrame:
    """Tip rate by six-hour part of the day."""
    hour = F.col("pickup_hour")
    part = (
        F.when(hour < 6, "00-06").when(hour < 12, "06-12").when(hour < 18, "12-18").otherwise("18-24")
    )
    return _tips(trips, part.alias("daypart"))


def tip_by_distance(trips: DataFrame) -> DataFrame:
    """Tip rate by distance class in miles."""
    distance = F.col("trip_distance")
    bucket = F.when(distance < 1, "<1").when(distance < 5, "1-5").when(distance <= 10, "5-10").otherwise(">10")
    return _tips(trips, bucket.alias("distance_class"))


def by_day_of_week(trips: DataFrame) -> DataFrame:
    days = trips.groupBy("pickup_dayofweek").agg(
        F.count("*").alias("total_trips"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("tip_percentage").alias("avg_tip_pct"),
    )
    return days.withColumn("pickup_dayname", calendar.day_name(F.col("pickup_dayofweek")))


def anomalous_days(daily: DataFrame, threshold: float = 15.0) -> DataFrame:
    """Days whose trips differ from the mean of their weekday by ``threshold`` percent or more."""
    weekday = Window.partitionBy("pickup_dayname")
    days = daily.select(
        "trip_date",
        "pickup_dayname",
        "total_trips",
        F.avg("total_trips").over(weekday).alias("usual_trips"),
        growth("total_trips", F.avg("total_trips").over(weekday)).alias("trips_deviation_pct"),
        growth("avg_tip_percentage", F.avg("avg_tip_percentage").over(weekday)).alias("tip_deviation_pct"),
    )
    return days.where(F.abs("trips_deviation_pct") >= threshold)


def growth_projection(financial: DataFrame, months: int = 12) -> DataFrame:
    """The last month carried forward by the mean monthly growth rates."""
    base = financial.agg(
        F.max("month_year").alias("last_month"),
        F.max_by("total_trips", "month_year").alias("last_trips"),
        F.max_by("gross_revenue", "month_year").alias("last_revenue"),
        F.avg("trips_growth_rate").alias("avg_trips_growth"),
        F.avg("revenue_growth_rate").alias("avg_revenue_growth"),
    )
    ahead = base.select("*", F.explode(F.sequence(F.lit(1), F.lit(months))).alias("months_ahead"))

    def carried(value: str, rate: str) -> Column:
        return F.col(value) * F.pow(F.lit(1.0) + F.col(rate) / F.lit(100.0), F.col("months_ahead"))

    return ahead.select(
        F.date_format(F.add_months(F.to_date("last_month", "yyyy-MM"), F.col("months_ahead")), "yyyy-MM").alias(
            "month_year"
        ),
        "months_ahead",
        "avg_trips_growth",
        "avg_revenue_growth",
        carried("last_trips", "avg_trips_growth").alias("projected_trips"),
        carried("last_revenue", "avg_revenue_growth").alias("projected_revenue"),
    )


def monthly_alerts(flagged: DataFrame) -> DataFrame:
    """Alert flags per month against the month before.

    Trips falling by more than 10 % two months in a row, tip rate by more than
    15 %, outlier rate up by more than 20 %, mean speed under 10 mph.
    """
    months = flagged.groupBy(F.trunc(F.to_date(PICKUP), "month").alias("month")).agg(
        F.count("*").alias("total_trips"),
        F.avg("tip_percentage").alias("avg_tip_pct"),
        percent(F.count_if("has_outlier"), F.count("*")).alias("outlier_pct"),
        F.avg("avg_speed_mph").alias("avg_speed"),
    )
    order = Window.orderBy("month")
    before = lambda value: previous(value, "month", order, F.add_months("month", -1))
    changes = months.withColumns(
        {
            "trips_change": growth("total_trips", before("total_trips")),
            "tip_change": growth("avg_tip_pct", before("avg_tip_pct")),
            "outlier_change": growth("outlier_pct", before("outlier_pct")),
        }
    )
    falling = F.col("trips_change") < -10
    alerts = {
        "alert_trips": falling & (before("trips_change") < -10),
        "alert_tips": F.col("tip_change") < -15,
        "alert_outliers": F.col("outlier_change") > 20,
        "alert_speed": F.col("avg_speed") < 10,
    }
    return changes.select(
        calendar.month_text("month").alias("month_year"),
        *changes.columns[1:],
        *[F.coalesce(test, F.lit(False)).alias(name) for name, test in alerts.items()],
    )


def weekly_variation(trips: DataFrame) -> DataFrame:
    """Weekly key figures and their change against the week before."""
    weeks = trips.groupBy(F.trunc(F.to_date(PICKUP), "week").alias("week")).agg(
        F.count("*").alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("tip_percentage").alias("avg_tip_pct"),
        F.count_distinct("PULocationID").alias("locations_served"),
    )
    order = Window.orderBy("week")
    before = lambda value: previous(value, "week", order, F.date_sub("week", 7))
    return weeks.select(
        calendar.date_text("week").alias("week_start"),
        *weeks.columns[1:],
        growth("total_trips", before("total_trips")).alias("trips_change"),
        growth("total_revenue", before("total_revenue")).alias("revenue_change"),
    )


def monthly_distance_growth(financial: DataFrame) -> DataFrame:
    """Mean distance per month and its change against the month before."""
    order = Window.orderBy("month")
    months = financial.select("month_year", "avg_miles_per_trip", F.make_date("pickup_year", "pickup_month", F.lit(1)).alias("month"))
    before = previous("avg_miles_per_trip", "month", order, F.add_months("month", -1))
    return months.select("month_year", "avg_miles_per_trip", growth("avg_miles_per_trip", before).alias("distance_growth_rate"))


def efficiency_metrics(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.avg("avg_speed_mph").alias("avg_speed"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.avg("passenger_count").alias("avg_passengers"),
    )


def _tips(trips: DataFrame, key: Column) -> DataFrame:
    return trips.groupBy(key).agg(F.count("*").alias("trips"), F.avg("tip_percentage").alias("avg_tip_pct"))


def _share(column: str) -> Column:
    """Percentage of the column total. For aggregated frames only: one task sees them whole."""
    return percent(column, F.sum(column).over(Window.partitionBy()))
