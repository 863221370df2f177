"""Trip data model: schema, code lists, rule presets and table layout."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# Names and types of the trip record, in file order.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField(PICKUP, T.TimestampType()),
        T.StructField(DROPOFF, T.TimestampType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)

# Meaning of the codes. Codes not listed have no description.
VENDOR_NAMES = {1: "Creative Mobile Technologies", 2: "VeriFone Inc"}
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
CREDIT_CARD, CASH = 1, 2


@dataclass(frozen=True)
class RuleSet:
    """Inclusive value limits a trip must meet. ``None`` switches a limit off."""

    name: str
    fare: tuple[float, float] | None = (0.0, 1000.0)
    total: tuple[float, float] | None = (0.0, 1500.0)
    tip: tuple[float, float] | None = (0.0, 500.0)
    distance: tuple[float, float] | None = (0.0, 500.0)
    minutes: tuple[float, float] | None = (1.0, 1440.0)
    passengers: tuple[float, float] | None = (0.0, 6.0)
    max_speed: float | None = 200.0
    positive_locations: bool = True
    vendors: tuple[int, ...] = (1, 2)


# ``CANONICAL`` feeds the silver table; the other two are the variants of the
# rule-driven filter report and of the lenient automated load.
CANONICAL = RuleSet("canonical")
WITHOUT_SPEED = RuleSet("without_speed", max_speed=None)
LENIENT = RuleSet("lenient", tip=None, passengers=None, positive_locations=False)

# Columns every report checks for nulls.
CRITICAL_COLUMNS = (PICKUP, DROPOFF, "trip_distance", "total_amount")
CRITICAL_COLUMNS_WITH_LOCATIONS = CRITICAL_COLUMNS + ("PULocationID", "DOLocationID")

# Columns screened by the interquartile-range rule.
OUTLIER_COLUMNS = (
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "trip_duration_minutes",
)


@dataclass(frozen=True)
class Thresholds:
    """Limits of the load and health checks."""

    min_records_per_file: int = 100_000
    max_null_percentage: float = 5.0
    max_outlier_percentage: float = 10.0
    min_revenue_per_day: float = 10_000.0
    min_quality_score: float = 0.8
    max_failure_rate: float = 0.2
    max_hours_since_last_run: float = 48.0


@dataclass(frozen=True)
class TableSpec:
    """A managed table: name, partition columns and clustering columns."""

    name: str
    partitions: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()

    def within(self, namespace: str) -> TableSpec:
        """The same table in a database whose name starts with ``namespace``."""
        return replace(self, name=f"{namespace}{self.name}")


BRONZE = TableSpec(
    "bronze.yellow_tripdata", ("ingestion_month",), (PICKUP, "VendorID")
)
# A month file holds some trips of other months. Keeping the load month as a
# partition lets a reload replace exactly the rows that came from that file.
SILVER = TableSpec(
    "silver.yellow_tripdata_clean",
    ("ingestion_month", "pickup_year", "pickup_month"),
    (PICKUP, "PULocationID", "DOLocationID", "VendorID"),
)
# What a load could not read, and the bounds its outlier flags were made with: replaced with the slice of the month.
UNREADABLE = TableSpec("bronze.unreadable_values", ("ingestion_month",))
BOUNDS = TableSpec("silver.outlier_bounds", ("ingestion_month",))
# The daily and hourly tables are partitioned by month so that one month can be
# replaced by a dynamic partition overwrite.
GOLD = {
    "daily": TableSpec(
        "gold.yellow_trip_metrics_daily", ("pickup_year", "pickup_month"), ("trip_date",)
    ),
    "hourly": TableSpec(
        "gold.yellow_trip_metrics_hourly",
        ("pickup_year", "pickup_month", "is_weekend"),
        ("pickup_hour", "trip_date"),
    ),
    "location": TableSpec(
        "gold.yellow_trip_location_metrics", ("location_type",), ("location_id",)
    ),
    "vendor": TableSpec(
        "gold.yellow_trip_vendor_performance", ("month_year",), ("VendorID",)
    ),
    "payment": TableSpec("gold.yellow_trip_payment_analysis"),
    "time_series": TableSpec("gold.yellow_trip_time_series", ("is_weekend",)),
    "route": TableSpec("gold.yellow_trip_route_analysis", (), ("trip_count",)),
    "financial": TableSpec("gold.yellow_trip_financial_summary"),
}
RUN_LOG = TableSpec("control.pipeline_execution_log", ("run_date",))
EVENT_LOG = TableSpec("control.pipeline_event_log", ("run_date",))
