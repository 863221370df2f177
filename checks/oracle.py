"""DuckDB twins of the registered queries, written independently of the Spark code."""

from __future__ import annotations

import re

# Trip view of the order tables, as the Spark side builds it from columns.
_TRIPS = """
SELECT CAST(l_suppkey % 3 + 1 AS INT) AS VendorID,
  o_orderdate + INTERVAL '1' SECOND * CAST((l_orderkey*7919 + l_linenumber*3571) % 86400 AS INT) AS tpep_pickup_datetime,
  o_orderdate + INTERVAL '1' SECOND * CAST((l_orderkey*7919 + l_linenumber*3571) % 86400
                                          + (l_orderkey*31 + l_partkey*17) % 7200 - 300 AS INT) AS tpep_dropoff_datetime,
  CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(l_partkey % 8 AS DOUBLE) END AS passenger_count,
  l_quantity AS trip_distance,
  CASE WHEN l_partkey % 8 = 7 THEN CAST(99 AS DOUBLE) ELSE CAST(l_partkey % 8 AS DOUBLE) END AS RatecodeID,
  l_linestatus AS store_and_fwd_flag,
  CAST(l_suppkey % 265 AS INT) AS PULocationID,
  CAST(l_partkey % 265 AS INT) AS DOLocationID,
  CAST(l_linenumber % 7 AS INT) AS payment_type,
  l_extendedprice / 100 AS fare_amount,
  CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS extra,
  CAST(0.5 AS DOUBLE) AS mta_tax,
  l_extendedprice / 100 * l_discount AS tip_amount,
  l_tax * 100 AS tolls_amount,
  CAST(0.3 AS DOUBLE) AS improvement_surcharge,
  l_extendedprice / 100 * (1 + l_discount) + l_tax * 100
    + CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END + CAST(3.3 AS DOUBLE) AS total_amount,
  CAST(2.5 AS DOUBLE) AS congestion_surcharge,
  CAST(0 AS DOUBLE) AS airport_fee
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# Moves exact half-digit ties aside before rounding, as on the Spark side.
NUDGE = "CAST(3.1e-8 AS DOUBLE)"

_SECONDS = "CAST(floor(epoch({})) AS BIGINT)"
_MINUTES = (
    f"(({_SECONDS.format('tpep_dropoff_datetime')} - {_SECONDS.format('tpep_pickup_datetime')}) / CAST(60 AS DOUBLE))"
)
_DOW = "(dayofweek(tpep_pickup_datetime) + 1)"
_DAY = "strftime(tpep_pickup_datetime, '%Y-%m-%d')"
_MONTH = "strftime(tpep_pickup_datetime, '%Y-%m')"
_PERIOD = (
    "CASE WHEN hour(tpep_pickup_datetime) BETWEEN 6 AND 11 THEN 'Morning'"
    " WHEN hour(tpep_pickup_datetime) BETWEEN 12 AND 17 THEN 'Afternoon'"
    " WHEN hour(tpep_pickup_datetime) BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END"
)
_VENDOR = "CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc' END"
_RATE = (
    "CASE RatecodeID WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'"
    " WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride' END"
)
_PAYMENT = (
    "CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'"
    " WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' END"
)
_OUTLIER_COLUMNS = ("trip_distance", "fare_amount", "tip_amount", "total_amount", "trip_duration_minutes")
_CRITICAL = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "total_amount")
_CRITICAL_6 = _CRITICAL + ("PULocationID", "DOLocationID")

_FILTER = """
  fare_amount BETWEEN 0 AND 1000 AND total_amount BETWEEN 0 AND 1500 AND trip_distance BETWEEN 0 AND 500
  AND tpep_dropoff_datetime > tpep_pickup_datetime
  AND trip_duration_minutes BETWEEN 1 AND 1440
  AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND VendorID IN (1, 2)"""
_LENIENT = _FILTER + " AND avg_speed_mph <= 200"
_HELPER = _FILTER + (
    " AND tip_amount BETWEEN 0 AND 500 AND passenger_count BETWEEN 0 AND 6 AND PULocationID > 0 AND DOLocationID > 0"
)
_CANONICAL = _HELPER + " AND avg_speed_mph <= 200"


def _flags(multiplier: str, rows: str = "s", bounds: str = "q") -> str:
    tests = ", ".join(
        f"coalesce({c} < q.{c}_1 - {multiplier} * (q.{c}_3 - q.{c}_1) OR {c} > q.{c}_3 + {multiplier} * (q.{c}_3 - q.{c}_1), false) AS {c}_outlier".replace("q.", f"{bounds}.")
        for c in _OUTLIER_COLUMNS
    )
    any_flag = " OR ".join(f"{c}_outlier" for c in _OUTLIER_COLUMNS)
    return f"SELECT *, ({any_flag}) AS has_outlier FROM (SELECT {rows}.*, {tests} FROM {rows} JOIN {bounds} USING (ingestion_month))"


def _quality(source: str, group: str = "") -> str:
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _CRITICAL)
    bad = "count(*) FILTER (WHERE total_amount < 0 OR total_amount > 1000 OR trip_distance > 200 OR avg_speed_mph > 150)"
    keys, by = (f"{group}, ", f"GROUP BY {group}") if group else ("", "")
    return (
        f"SELECT {keys}count(*) AS total_records, {nulls} AS null_values, {bad} AS outlier_records,"
        f" greatest(0, 1 - ({nulls}) / (count(*) * 4) - {bad} / count(*)) AS quality_score FROM {source} {by}"
    )


# Named steps; each query states the last one it needs and gets all before it.
_STEPS = {
    "t": _TRIPS,
    "b": f"SELECT *, 'yellow_tripdata_' || {_MONTH} || '.parquet' AS source_file, {_MONTH} AS ingestion_month FROM t",
    "d": f"""SELECT *, {_MINUTES} AS trip_duration_minutes,
      CASE WHEN {_MINUTES} > 0 THEN trip_distance / ({_MINUTES} / CAST(60 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END AS avg_speed_mph,
      CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour, CAST({_DOW} AS INTEGER) AS pickup_dayofweek,
      dayname(tpep_pickup_datetime) AS pickup_dayname,
      CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
      {_PERIOD} AS time_period, {_DOW} IN (1, 7) AS is_weekend,
      CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tip_percentage,
      {_DAY} AS day, {_MONTH} AS month,
      {_VENDOR} AS vendor_name, {_RATE} AS rate_code_desc, {_PAYMENT} AS payment_type_desc
      FROM b""",
    "s": f"SELECT * FROM d WHERE {_CANONICAL}",
    "q": "SELECT ingestion_month, "
    + ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3" for c in _OUTLIER_COLUMNS
    )
    + " FROM s GROUP BY 1",
    "f": _flags("1.5"),
    "daily": """SELECT day AS trip_date, pickup_year, pickup_month, CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
      pickup_dayname, is_weekend, count(*) AS total_trips, count(DISTINCT VendorID) AS active_vendors,
      sum(total_amount) AS total_revenue, sum(fare_amount) AS total_fare, sum(tip_amount) AS total_tips, sum(tolls_amount) AS total_tolls,
      avg(total_amount) AS avg_total_amount, avg(fare_amount) AS avg_fare_amount, avg(tip_amount) AS avg_tip_amount,
      avg(tip_percentage) AS avg_tip_percentage, sum(trip_distance) AS total_distance, avg(trip_distance) AS avg_trip_distance,
      sum(trip_duration_minutes) AS total_duration_minutes, avg(trip_duration_minutes) AS avg_trip_duration, avg(avg_speed_mph) AS avg_speed,
      sum(passenger_count) AS total_passengers, avg(passenger_count) AS avg_passengers_per_trip,
      count(*) FILTER (WHERE has_outlier) AS trips_with_outliers,
      count(*) FILTER (WHERE time_period = 'Morning') AS morning_trips, count(*) FILTER (WHERE time_period = 'Afternoon') AS afternoon_trips,
      count(*) FILTER (WHERE time_period = 'Evening') AS evening_trips, count(*) FILTER (WHERE time_period = 'Night') AS night_trips,
      sum(total_amount) / nullif(sum(trip_distance), 0) AS revenue_per_mile,
      count(*) FILTER (WHERE has_outlier) / count(*) * CAST(100 AS DOUBLE) AS outlier_percentage
      FROM f GROUP BY ALL""",
    "hourly": """SELECT pickup_hour, pickup_dayname, is_weekend, day AS trip_date, count(*) AS total_trips,
      avg(total_amount) AS avg_revenue_per_trip, avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
      avg(tip_percentage) AS avg_tip_percentage, avg(avg_speed_mph) AS avg_speed,
      count(DISTINCT PULocationID) AS unique_pickup_locations, count(DISTINCT DOLocationID) AS unique_dropoff_locations
      FROM s GROUP BY 1, 2, 3, 4""",
    "vendor_months": """SELECT VendorID, vendor_name, month AS month_year, count(*) AS total_trips, sum(total_amount) AS total_revenue,
      avg(total_amount) AS avg_revenue_per_trip, avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip,
      avg(tip_percentage) AS avg_tip_percentage, avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
      avg(avg_speed_mph) AS avg_speed, count(*) FILTER (WHERE has_outlier) AS problematic_trips,
      count(DISTINCT PULocationID) AS coverage_pickup_locations, count(DISTINCT DOLocationID) AS coverage_dropoff_locations,
      count(*) FILTER (WHERE payment_type = 1) AS credit_card_trips, count(*) FILTER (WHERE payment_type = 2) AS cash_trips
      FROM f GROUP BY 1, 2, 3""",
    "vendor": """SELECT *, total_trips / sum(total_trips) OVER (PARTITION BY month_year) * CAST(100 AS DOUBLE) AS market_share_trips,
      total_revenue / sum(total_revenue) OVER (PARTITION BY month_year) * CAST(100 AS DOUBLE) AS market_share_revenue,
      problematic_trips / total_trips * CAST(100 AS DOUBLE) AS outlier_rate,
      credit_card_trips / total_trips * CAST(100 AS DOUBLE) AS credit_card_rate FROM vendor_months""",
    "payment": """SELECT payment_type, payment_type_desc, pickup_dayname, time_period, count(*) AS total_trips,
      sum(total_amount) AS total_revenue, avg(total_amount) AS avg_amount, avg(tip_amount) AS avg_tip,
      avg(tip_percentage) AS avg_tip_percentage, avg(fare_amount) AS avg_fare, stddev_samp(tip_percentage) AS tip_percentage_std,
      sum(total_amount) / sum(sum(total_amount)) OVER () * CAST(100 AS DOUBLE) AS revenue_share FROM s GROUP BY 1, 2, 3, 4""",
    "series": """SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d %H') || ':00:00' AS datetime_hour, pickup_hour AS hour_of_day,
      pickup_dayofweek AS day_of_week, is_weekend, count(*) AS trips_count, sum(total_amount) AS revenue,
      avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
      sin(pickup_hour * 2 * CAST(3.14159 AS DOUBLE) / 24) AS hour_sin, cos(pickup_hour * 2 * CAST(3.14159 AS DOUBLE) / 24) AS hour_cos,
      sin(pickup_dayofweek * 2 * CAST(3.14159 AS DOUBLE) / 7) AS day_sin, cos(pickup_dayofweek * 2 * CAST(3.14159 AS DOUBLE) / 7) AS day_cos
      FROM s GROUP BY ALL""",
    "route": """SELECT PULocationID, DOLocationID, count(*) AS trip_count, sum(total_amount) AS total_revenue,
      avg(total_amount) AS avg_revenue_per_trip, avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
      avg(avg_speed_mph) AS avg_speed, avg(tip_percentage) AS avg_tip_percentage, stddev_samp(total_amount) AS revenue_std,
      count(*) FILTER (WHERE is_weekend) AS weekend_trips, count(*) FILTER (WHERE time_period = 'Morning') AS morning_trips,
      count(*) FILTER (WHERE time_period = 'Evening') AS evening_trips,
      count(*) FILTER (WHERE is_weekend) / count(*) * CAST(100 AS DOUBLE) AS weekend_ratio,
      sum(total_amount) / nullif(avg(trip_distance), 0) AS revenue_per_mile,
      avg(avg_speed_mph) * avg(tip_percentage) / nullif(avg(trip_duration_minutes), 0) AS route_efficiency_score
      FROM s GROUP BY 1, 2""",
    "months": """SELECT pickup_year, pickup_month, month AS month_year, count(*) AS total_trips, count(DISTINCT day) AS active_days,
      sum(total_amount) AS gross_revenue, sum(fare_amount) AS fare_revenue, sum(tip_amount) AS tip_revenue, sum(tolls_amount) AS tolls_revenue,
      sum(extra) AS extra_revenue, sum(trip_distance) AS total_miles, sum(trip_duration_minutes) / CAST(60 AS DOUBLE) AS total_hours,
      sum(passenger_count) AS total_passengers, avg(total_amount) AS avg_revenue_per_trip, avg(trip_distance) AS avg_miles_per_trip,
      avg(tip_percentage) AS avg_tip_rate FROM s GROUP BY 1, 2, 3""",
    "financial": """SELECT *, gross_revenue / nullif(total_miles, 0) AS revenue_per_mile, total_trips / active_days AS trips_per_day,
      gross_revenue / active_days AS revenue_per_day,
      (gross_revenue - lag(gross_revenue) OVER w) / nullif(lag(gross_revenue) OVER w, 0) * CAST(100 AS DOUBLE) AS revenue_growth_rate,
      (total_trips - lag(total_trips) OVER w) / nullif(lag(total_trips) OVER w, 0) * CAST(100 AS DOUBLE) AS trips_growth_rate
      FROM months WINDOW w AS (ORDER BY month_year)""",
}

_PICKUP_SIDE = """SELECT PULocationID AS location_id, count(*) AS pickup_count, avg(trip_distance) AS avg_distance_from_location,
  avg(total_amount) AS avg_revenue_from_location, avg(tip_percentage) AS avg_tip_from_location,
  count(DISTINCT DOLocationID) AS unique_destinations, 'pickup' AS location_type FROM s GROUP BY 1"""
_DROPOFF_SIDE = """SELECT DOLocationID, count(*), avg(trip_distance), avg(total_amount), avg(tip_percentage),
  count(DISTINCT PULocationID), 'dropoff' FROM s GROUP BY 1"""
_LOCATION = f"{_PICKUP_SIDE} UNION ALL {_DROPOFF_SIDE}"

_STEPS["location"] = _LOCATION

# The month loads: a trip is in the file of its dropoff month; files from 1998 on have texts for payment type 3 that are no passenger count.
_LABEL = "strftime(tpep_dropoff_datetime, '%Y-%m')"
_ABSENT, _AGAIN, _SECOND = "'1999-05'", "'2000-03'", "'1998-01'"
_STEPS["files"] = f"""SELECT * REPLACE ({_LABEL} AS ingestion_month,
  CASE WHEN {_LABEL} < {_SECOND} OR payment_type <> 3 THEN passenger_count END AS passenger_count) FROM d WHERE {_LABEL} <> {_ABSENT}"""
_STEPS["fs"] = f"SELECT * FROM files WHERE {_CANONICAL}"
_STEPS["fq"] = _STEPS["q"].replace("FROM s ", "FROM fs ")
_STEPS["ff"] = _flags("1.5", "fs", "fq")
_STEPS["fdaily"] = _STEPS["daily"].replace("FROM f ", "FROM ff ")
_STEPS["fhourly"] = _STEPS["hourly"].replace("FROM s ", "FROM fs ")
_STEPS["tried"] = f"""SELECT strftime(m, '%Y-%m') AS label, CASE WHEN strftime(m, '%Y-%m') < {_SECOND} THEN 1 ELSE 2 END AS k
  FROM (SELECT unnest(generate_series(min(date_trunc('month', tpep_dropoff_datetime)), max(date_trunc('month', tpep_dropoff_datetime)), INTERVAL 1 MONTH)) AS m FROM d)
  UNION ALL SELECT {_AGAIN}, 3"""
_STEPS["log_bronze"] = f"""SELECT ingestion_month AS label, count(*) AS n, count(*) FILTER (WHERE payment_type = 3 AND ingestion_month >= {_SECOND}) AS bad
  FROM files GROUP BY 1"""
_STEPS["log_silver"] = _quality("fs", "ingestion_month")
_STEPS["log_days"] = f"""SELECT k, pickup_year, pickup_month, count(DISTINCT day) AS days FROM fs, (VALUES (1), (2), (3)) AS loads(k)
  WHERE CASE WHEN ingestion_month < {_SECOND} THEN 1 ELSE 2 END <= k GROUP BY 1, 2, 3"""
_STEPS["touched"] = "SELECT DISTINCT ingestion_month, pickup_year, pickup_month FROM fs"
_STEPS["log_gold"] = """SELECT ingestion_month AS label, k, CAST(sum(days) AS BIGINT) AS n FROM touched JOIN log_days USING (pickup_year, pickup_month) GROUP BY 1, 2"""
_STEPS["log"] = """SELECT 'load' || k || '_' || label AS execution_id, 'trips' AS pipeline_name, label, bad,
  [TIMESTAMP '2024-01-20 06:00:00', TIMESTAMP '2024-01-30 06:00:00', TIMESTAMP '2024-01-31 06:00:00'][k] AS start_time, start_time AS end_time,
  CASE WHEN b.n IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN b.n IS NULL THEN 'DATA_CHECK' ELSE 'COMPLETED' END AS stage,
  b.n AS records_bronze, CASE WHEN b.n IS NOT NULL THEN coalesce(total_records, 0) END AS records_silver,
  CASE WHEN b.n IS NOT NULL THEN coalesce(g.n, 0) END AS records_gold, coalesce(b.n, 0) + coalesce(total_records, 0) + coalesce(g.n, 0) AS records_processed,
  CAST(0 AS DOUBLE) AS execution_time_minutes, CASE WHEN b.n IS NULL THEN 'no trips for ' || label END AS error_message,
  CASE WHEN b.n IS NOT NULL THEN coalesce(quality_score, 0) END AS quality_score
  FROM tried LEFT JOIN log_bronze AS b USING (label) LEFT JOIN log_silver ON label = ingestion_month LEFT JOIN log_gold AS g USING (label, k)"""
_ORDER = list(_STEPS)


def _needed(body: str) -> list[str]:
    """Steps a query mentions, directly or through other steps, in their order."""
    found: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in _ORDER:
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                found.add(name)
                pending.append(_STEPS[name])
    return [name for name in _ORDER if name in found]


def _query(body: str, rounded: str = "") -> str:
    """The query with its steps; the columns named in ``rounded`` are cut to six digits, large ones to three."""
    replace = ", ".join(f"CASE WHEN abs({c}) >= 1e6 THEN round({c} + {NUDGE}, 3) ELSE round({c} + {NUDGE}, 6) END AS {c}" for c in rounded.split())
    steps = ",\n".join(f"{name} AS ({_STEPS[name]})" for name in _needed(body))
    star = f"* REPLACE ({replace})" if replace else "*"
    return f"WITH {steps}\nSELECT {star} FROM (\n{body}\n)"


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


_KEY = f"VendorID, {_text('tpep_pickup_datetime')}, PULocationID, DOLocationID, fare_amount, tip_amount"
_KEY_ROUNDED = "fare_amount tip_amount "
_MONEY = (
    "passenger_count trip_distance RatecodeID fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge"
    " total_amount congestion_surcharge airport_fee"
)
_TRIP_COLUMNS = (
    f"VendorID, {_text('tpep_pickup_datetime')}, {_text('tpep_dropoff_datetime')}, passenger_count, trip_distance, RatecodeID,"
    " store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,"
    " improvement_surcharge, total_amount, congestion_surcharge, airport_fee"
)
_DERIVED = (
    "trip_duration_minutes, avg_speed_mph, pickup_hour, pickup_dayofweek, pickup_dayname, pickup_month, pickup_year,"
    " time_period, is_weekend, tip_percentage"
)
_FLAG_COLUMNS = ", ".join(f"{c}_outlier" for c in _OUTLIER_COLUMNS) + ", has_outlier"
_FUTURE = "tpep_pickup_datetime > (SELECT max(tpep_pickup_datetime) - INTERVAL 12 HOUR FROM t)"
_PARTS = "fare_amount + extra + mta_tax + improvement_surcharge"
_DUPLICATES = "(SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t))"

_NULLS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in _CRITICAL)
_NULL_PCTS = ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) / count(*) * CAST(100 AS DOUBLE) AS {c}_null_pct" for c in _CRITICAL
)
_METRICS = f"""SELECT count(*) AS total_records,
  {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls' for c in _CRITICAL_6)},
  {_DUPLICATES} AS duplicate_records, count(*) FILTER (WHERE total_amount < 0) AS negative_amounts,
  count(*) FILTER (WHERE trip_distance = 0) AS zero_distance_trips, count(*) FILTER (WHERE {_FUTURE}) AS future_trips,
  {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) / count(*) * CAST(100 AS DOUBLE) AS {c}_null_pct' for c in _CRITICAL_6)},
  greatest(0, 1 - ({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in _CRITICAL_6)} + {_DUPLICATES}
    + count(*) FILTER (WHERE total_amount < 0) + count(*) FILTER (WHERE {_FUTURE})) / count(*)) AS quality_score
  FROM t"""
_SUMMARY = f"""SELECT count(*) AS total_records, strftime(min(tpep_pickup_datetime), '%Y-%m-%d %H:%M:%S') AS start_date,
  strftime(max(tpep_pickup_datetime), '%Y-%m-%d %H:%M:%S') AS end_date,
  CAST(floor(({_SECONDS.format('max(tpep_pickup_datetime)')} - {_SECONDS.format('min(tpep_pickup_datetime)')}) / 86400) AS BIGINT) AS days,
  sum(total_amount) AS total_revenue, avg(total_amount) AS avg_revenue, sum(fare_amount) AS total_fare, avg(fare_amount) AS avg_fare,
  sum(tip_amount) AS total_tips, avg(tip_amount) AS avg_tip, sum(trip_distance) AS total_distance, avg(trip_distance) AS avg_distance,
  sum(passenger_count) AS total_passengers, avg(passenger_count) AS avg_passengers,
  count(DISTINCT PULocationID) AS unique_pickup_locations, count(DISTINCT DOLocationID) AS unique_dropoff_locations,
  count(DISTINCT VendorID) AS unique_vendors FROM t"""
_STEPS["metrics"] = _METRICS
_STEPS["summary"] = _SUMMARY
_ORDER += ["metrics", "summary"]


def _rules() -> str:
    tests = {
        "valid_trip_sequence": "tpep_pickup_datetime < tpep_dropoff_datetime",
        "consistent_amounts": f"total_amount >= {_PARTS} - CAST(1 AS DOUBLE)",
        "credit_card_trips": "payment_type = 1",
        "tips_with_credit": "payment_type = 1 AND tip_amount > 0",
        "reasonable_speed": "avg_speed_mph BETWEEN 0.5 AND 80",
        "valid_location_ids": "PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS valid_count,"
        f" count(*) - count(*) FILTER (WHERE {test}) AS invalid_count,"
        f" count(*) FILTER (WHERE {test}) / count(*) * CAST(100 AS DOUBLE) AS valid_percentage FROM d"
        for name, test in tests.items()
    )
    return (
        "SELECT *, bool_and(valid_percentage > 95) OVER () AS all_rules_passed,"
        " bool_and(valid_percentage > 95 OR rule IN ('credit_card_trips', 'tips_with_credit')) OVER () AS rules_passed"
        f" FROM ({rows})"
    )


def _threshold_checks() -> str:
    null_pct = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) / count(*) * CAST(100 AS DOUBLE)" for c in _CRITICAL)
    return f"""SELECT check_name, value, "limit", CASE WHEN check_name LIKE 'min%' THEN value >= "limit" ELSE value <= "limit" END AS passed FROM (
      SELECT 'min_records_per_file' AS check_name, (SELECT CAST(min(n) AS DOUBLE) FROM (SELECT count(*) AS n FROM b GROUP BY ingestion_month)) AS value, CAST(50 AS DOUBLE) AS "limit"
      UNION ALL SELECT 'max_null_percentage', (SELECT greatest({null_pct}) FROM b), CAST(5 AS DOUBLE)
      UNION ALL SELECT 'max_outlier_percentage', (SELECT count(*) FILTER (WHERE has_outlier) / count(*) * CAST(100 AS DOUBLE) FROM f), CAST(2 AS DOUBLE)
      UNION ALL SELECT 'min_revenue_per_day', (SELECT min(r) FROM (SELECT sum(total_amount) AS r FROM f GROUP BY day)), CAST(5 AS DOUBLE))"""


def _report() -> str:
    parts = {
        "summary": ["metrics.total_records", "metrics.quality_score"],
        "financial": ["summary.total_revenue", "summary.avg_revenue", "summary.total_tips"],
        "operational": ["summary.total_distance", "summary.avg_distance", "summary.total_passengers"],
        "quality": ["metrics.duplicate_records", "metrics.negative_amounts", "metrics.zero_distance_trips", "metrics.future_trips"],
    }
    rows = [
        f"SELECT '{section}' AS section, '{item.split('.')[1]}' AS metric, CAST({item.split('.')[1]} AS DOUBLE) AS value FROM {item.split('.')[0]}"
        for section, items in parts.items()
        for item in items
    ]
    rows += [f"SELECT 'null_percentage', '{c}', {c}_null_pct FROM metrics" for c in _CRITICAL_6]
    return " UNION ALL ".join(rows)


def _bounds() -> str:
    return " UNION ALL ".join(
        f"SELECT ingestion_month, '{c}' AS column_name, {c}_1 AS q1, {c}_3 AS q3, {c}_1 - 1.5 * ({c}_3 - {c}_1) AS lower_bound,"
        f" {c}_3 + 1.5 * ({c}_3 - {c}_1) AS upper_bound FROM q"
        for c in _OUTLIER_COLUMNS
    )


def _statistics() -> str:
    """Nothing is null in these columns; the catalog keeps no range of texts, and nothing of a table written since."""
    daily = "trip_date pickup_year pickup_month pickup_day is_weekend total_trips active_vendors morning_trips".split()
    fresh = [("daily", c, "CAST(0 AS BIGINT)", True, False) for c in daily]
    stale = [("hourly", c, "CAST(NULL AS BIGINT)", c == "pickup_dayname", True) for c in ("pickup_hour", "pickup_dayname", "total_trips")]
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, {known} AS known_nulls, (SELECT count(*) - count({c}) FROM f{table}) AS nulls,"
        f" {same} AS same_range, {is_stale} AS is_stale"
        for table, c, known, same, is_stale in fresh + stale
    )


_EVENTS = """SELECT * FROM (
  SELECT 'WARNING' AS level, 'few records in the file' AS message, 'count' AS detail, CAST(NULL AS VARCHAR) AS value, count(*) AS n_events,
    CAST(sum(records_bronze) AS DOUBLE) AS total FROM log WHERE records_bronze < 700
  UNION ALL SELECT 'WARNING', 'quality below the limit', 'quality_score', NULL, count(*), sum(quality_score) FROM log WHERE quality_score < 0.45
  UNION ALL SELECT 'WARNING', 'unreadable values', 'column', 'passenger_count', count(*), NULL FROM log WHERE bad > 0
  UNION ALL SELECT 'WARNING', 'unreadable values', 'count', NULL, count(*), CAST(sum(bad) AS DOUBLE) FROM log WHERE bad > 0
  UNION ALL SELECT 'ERROR', 'load failed', 'stage', 'DATA_CHECK', count(*), NULL FROM log WHERE status = 'FAILED') WHERE n_events > 0"""


def _narrow_flags() -> str:
    return f"SELECT {_KEY}, {_FLAG_COLUMNS} FROM ({_flags('0.5')})"


def _health(hours: int) -> str:
    return f"""SELECT recent_runs, failed_runs, avg_quality_score, {_text('last_run')}, last_status, failure_rate, hours_since_last_run,
      coalesce(failure_rate > 0.2, false) AS failure_issue, coalesce(avg_quality_score < 0.8, false) AS quality_issue,
      coalesce(hours_since_last_run > 48, false) AS freshness_issue,
      CASE WHEN failure_rate > 0.2 THEN 'UNHEALTHY' WHEN avg_quality_score < 0.8 OR hours_since_last_run > 48 THEN 'WARNING' ELSE 'HEALTHY' END AS health_status
      FROM (SELECT *, failed_runs / nullif(recent_runs, 0) AS failure_rate, (epoch(now_) - epoch(last_run)) / 3600 AS hours_since_last_run
        FROM (SELECT count(*) FILTER (WHERE start_time >= since) AS recent_runs,
          count(*) FILTER (WHERE start_time >= since AND status = 'FAILED') AS failed_runs,
          avg(quality_score) FILTER (WHERE start_time >= since AND status = 'SUCCESS') AS avg_quality_score,
          max(start_time) AS last_run, arg_max(status, start_time) AS last_status, max(now_) AS now_
          FROM (SELECT *, CAST(CAST(now_ AS DATE) - 7 AS TIMESTAMP) AS since
            FROM (SELECT *, (SELECT max(start_time) + INTERVAL {hours} HOUR FROM log) AS now_ FROM log))))"""


_DAILY_DOUBLES = (
    "total_revenue total_fare total_tips total_tolls avg_total_amount avg_fare_amount avg_tip_amount avg_tip_percentage"
    " total_distance avg_trip_distance total_duration_minutes avg_trip_duration avg_speed total_passengers"
    " avg_passengers_per_trip revenue_per_mile outlier_percentage"
)
_HOURLY_DOUBLES = "avg_revenue_per_trip avg_distance avg_duration avg_tip_percentage avg_speed"
_LOCATION_DOUBLES = "avg_distance_from_location avg_revenue_from_location avg_tip_from_location"
_VENDOR_DOUBLES = (
    "total_revenue avg_revenue_per_trip avg_fare avg_tip avg_tip_percentage avg_distance avg_duration avg_speed"
    " market_share_trips market_share_revenue outlier_rate credit_card_rate"
)
_DAILY_BASIC = """SELECT day AS trip_date, pickup_year, pickup_month, CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day, is_weekend,
  count(*) AS total_trips, sum(total_amount) AS total_revenue, avg(total_amount) AS avg_total_amount, avg(trip_distance) AS avg_trip_distance,
  avg(trip_duration_minutes) AS avg_trip_duration, avg(tip_percentage) AS avg_tip_percentage, sum(passenger_count) AS total_passengers
  FROM s GROUP BY ALL"""
_DAILY_BASIC_DOUBLES = (
    "total_revenue avg_total_amount avg_trip_distance avg_trip_duration avg_tip_percentage total_passengers"
)


def _mapped(code: str, label: str) -> str:
    return f"SELECT {code}, {label}, count(*) AS n_rows FROM d GROUP BY 1, 2"


def _validation() -> str:
    tables = {
        "daily": ("daily", 30, "total_trips"),
        "hourly": ("hourly", 12, "total_trips"),
        "location": ("location", 7, "pickup_count"),
        "vendor": ("vendor", 21, "total_trips"),
        "payment": ("payment", 12, "total_trips"),
        "time_series": ("series", 12, "trips_count"),
        "route": ("route", 16, "trip_count"),
        "financial": ("financial", 21, "total_trips"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST({width} AS INTEGER) AS n_columns,"
        f" count(*) FILTER (WHERE {trips} IS NULL) AS null_total_trips FROM {step}"
        for name, (step, width, trips) in tables.items()
    )


ORACLE_SQL: dict[str, str] = {
    "bronze_ingest": _query(f"SELECT {_TRIP_COLUMNS}, source_file, ingestion_month FROM b", _MONEY),
    "month_slice": _query(
        "SELECT ingestion_month, VendorID, count(*) AS n_rows, sum(total_amount) AS total_revenue FROM b WHERE ingestion_month = '1999-03' GROUP BY 1, 2",
        "total_revenue",
    ),
    "month_replace": _query(_DAILY_BASIC, _DAILY_BASIC_DOUBLES),
    "schema_evolve_union": _query(
        """SELECT ingestion_month, count(*) AS n_rows, count(*) FILTER (WHERE ingestion_month >= '1999-01') AS with_congestion_surcharge,
        sum(congestion_surcharge) FILTER (WHERE ingestion_month >= '1999-01') AS congestion_surcharge,
        count(*) FILTER (WHERE ingestion_month >= '1999-01') AS with_airport_fee FROM b GROUP BY 1""",
        "congestion_surcharge",
    ),
    "derived_columns": _query(
        f"SELECT {_KEY}, {_DERIVED} FROM d", _KEY_ROUNDED + "trip_duration_minutes avg_speed_mph tip_percentage"
    ),
    "temporal_features": _query(
        f"""SELECT {_KEY}, pickup_hour, CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day, pickup_month, pickup_year, pickup_dayofweek,
        pickup_dayname, time_period, is_weekend, pickup_hour BETWEEN 9 AND 17 AS is_business_hour FROM d""",
        _KEY_ROUNDED,
    ),
    "trip_metrics": _query(
        f"""SELECT {_KEY}, trip_duration_minutes, avg_speed_mph, tip_percentage,
        CASE WHEN trip_distance > 0 THEN total_amount / trip_distance ELSE 0 END AS cost_per_mile,
        CASE WHEN trip_duration_minutes > 0 THEN total_amount / trip_duration_minutes ELSE 0 END AS revenue_per_minute FROM d""",
        _KEY_ROUNDED + "trip_duration_minutes avg_speed_mph tip_percentage cost_per_mile revenue_per_minute",
    ),
    "silver_filter": _query(f"SELECT {_KEY} FROM s", _KEY_ROUNDED),
    "silver_filter_helper": _query(f"SELECT {_KEY} FROM d WHERE {_HELPER}", _KEY_ROUNDED),
    "silver_filter_lenient": _query(f"SELECT {_KEY} FROM d WHERE {_LENIENT}", _KEY_ROUNDED),
    "quality_filter_report": _query(
        f"""SELECT *, original_records - filtered_records AS removed_records,
        (original_records - filtered_records) / original_records * CAST(100 AS DOUBLE) AS removal_rate,
        filtered_records / original_records AS quality_score
        FROM (SELECT count(*) AS original_records, count(*) FILTER (WHERE {_HELPER}) AS filtered_records FROM d)""",
        "removal_rate quality_score",
    ),
    "silver_rows": _query(
        f"""SELECT {_TRIP_COLUMNS}, source_file, ingestion_month, {_DERIVED}, vendor_name, rate_code_desc, payment_type_desc, {_FLAG_COLUMNS},
        '1.0' AS silver_processing_version FROM f""",
        _MONEY + " trip_duration_minutes avg_speed_mph tip_percentage",
    ),
    "map_vendor": _query(_mapped("VendorID", "vendor_name")),
    "map_ratecode": _query(_mapped("RatecodeID", "rate_code_desc")),
    "map_payment": _query(_mapped("payment_type", "payment_type_desc")),
    "business_mappings": _query(
        f"SELECT {_KEY}, RatecodeID, payment_type, vendor_name, rate_code_desc, payment_type_desc FROM d", _KEY_ROUNDED
    ),
    "schema_issues": _query(
        """SELECT column_name, issue, expected_type, actual_type, (SELECT count(*) FROM b) AS n_rows FROM (VALUES
        ('airport_fee', 'missing', 'double', NULL), ('source_file', 'extra', NULL, 'string'), ('ingestion_month', 'extra', NULL, 'string'),
        ('extra', 'type', 'double', 'string')) AS v(column_name, issue, expected_type, actual_type)"""
    ),
    "bronze_quality": _query(
        f"""SELECT ingestion_month, count(*) AS total_rows, {_NULLS}, count(*) FILTER (WHERE total_amount < 0) AS negative_amounts,
        count(*) FILTER (WHERE trip_distance = 0) AS zero_distance_trips, {_NULL_PCTS} FROM b GROUP BY 1""",
        " ".join(f"{c}_null_pct" for c in _CRITICAL),
    ),
    "quality_metrics": _query("SELECT * FROM metrics", " ".join(f"{c}_null_pct" for c in _CRITICAL_6) + " quality_score"),
    "duplicate_count": _query(
        """SELECT (SELECT count(*) FROM t) + (SELECT count(*) FROM t WHERE payment_type = 2) AS total_records,
        (SELECT count(*) FROM t) + (SELECT count(*) FROM t WHERE payment_type = 2) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS duplicate_records
        FROM (SELECT 1) one WHERE EXISTS (SELECT 1 FROM t)"""
    ),
    "silver_quality_score": _query(_quality("d"), "quality_score"),
    "silver_quality_by_month": _query(_quality("s", "pickup_year, pickup_month"), "quality_score"),
    "business_rules": _query(_rules(), "valid_percentage"),
    "threshold_checks": _query(_threshold_checks(), "value"),
    "summary_statistics": _query(
        "SELECT * FROM summary",
        "total_revenue avg_revenue total_fare avg_fare total_tips avg_tip total_distance avg_distance total_passengers avg_passengers",
    ),
    "quality_report_long": _query(_report(), "value"),
    "quality_indicators": _query(
        f"""SELECT count(*) FILTER (WHERE {_CANONICAL}) / count(*) * CAST(100 AS DOUBLE) AS quality_rate,
        count(*) FILTER (WHERE total_amount >= {_PARTS} - CAST(1 AS DOUBLE)) / count(*) * CAST(100 AS DOUBLE) AS consistency_rate,
        100 - ({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in _CRITICAL_6)}) / (count(*) * 6) * CAST(100 AS DOUBLE) AS completeness_rate,
        (SELECT count(*) FILTER (WHERE has_outlier) / count(*) * CAST(100 AS DOUBLE) FROM f) AS outlier_rate FROM d""",
        "quality_rate consistency_rate completeness_rate outlier_rate",
    ),
    "cleaning_rate": _query(
        f"""SELECT bronze_records, silver_records, bronze_records - silver_records AS removed_records,
        (bronze_records - silver_records) / bronze_records * CAST(100 AS DOUBLE) AS removed_percentage,
        silver_records / bronze_records * CAST(100 AS DOUBLE) AS quality_rate
        FROM (SELECT count(*) AS bronze_records, count(*) FILTER (WHERE {_CANONICAL}) AS silver_records FROM d)""",
        "removed_percentage quality_rate",
    ),
    "outlier_flags": _query(f"SELECT {_KEY}, {_FLAG_COLUMNS} FROM f", _KEY_ROUNDED),
    "outlier_flags_narrow": _query(_narrow_flags(), _KEY_ROUNDED),
    "outlier_bounds": _query(_bounds(), "q1 q3 lower_bound upper_bound"),
    "outlier_summary": _query(
        f"""SELECT count(*) AS total_records, count(*) FILTER (WHERE has_outlier) AS outlier_records,
        {', '.join(f'count(*) FILTER (WHERE {c}_outlier) AS {c}_outliers' for c in _OUTLIER_COLUMNS)},
        count(*) FILTER (WHERE has_outlier) / count(*) * CAST(100 AS DOUBLE) AS outlier_percentage FROM f""",
        "outlier_percentage",
    ),
    "outlier_causes": _query(
        " UNION ALL ".join(
            f"SELECT '{name}' AS cause, count(*) FILTER (WHERE {test}) AS trips, count(*) FILTER (WHERE {test}) / count(*) * CAST(100 AS DOUBLE) AS pct_of_trips FROM s"
            for name, test in {
                "distance_over_100_miles": "trip_distance > 100",
                "speed_over_80_mph": "avg_speed_mph > 80",
                "inconsistent_amounts": f"total_amount < {_PARTS} - CAST(1 AS DOUBLE)",
            }.items()
        ),
        "pct_of_trips",
    ),
    "bronze_month_counts": _query("SELECT ingestion_month, count(*) AS n_rows FROM b GROUP BY 1"),
    "period_stats": _query(
        """SELECT strftime(min(tpep_pickup_datetime), '%Y-%m-%d %H:%M:%S') AS min_date, strftime(max(tpep_pickup_datetime), '%Y-%m-%d %H:%M:%S') AS max_date,
        count(DISTINCT ingestion_month) AS distinct_months, count(*) AS total_records FROM b"""
    ),
    "vendor_counts": _query("SELECT VendorID, count(*) AS n_rows FROM t GROUP BY 1"),
    "bronze_money_stats": _query(
        "SELECT avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip, avg(total_amount) AS avg_total, max(total_amount) AS max_total, min(total_amount) AS min_total FROM t",
        "avg_fare avg_tip avg_total max_total min_total",
    ),
    "silver_money_stats": _query(
        """SELECT avg(fare_amount) AS avg_fare, stddev_samp(fare_amount) AS std_fare, avg(tip_amount) AS avg_tip, avg(tip_percentage) AS avg_tip_pct,
        avg(total_amount) AS avg_total, avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration FROM s""",
        "avg_fare std_fare avg_tip avg_tip_pct avg_total avg_distance avg_duration",
    ),
    "silver_month_counts": _query("SELECT pickup_month, pickup_year, count(*) AS n_rows FROM s GROUP BY 1, 2"),
    "silver_by_vendor": _query(
        "SELECT vendor_name, count(*) AS trips, avg(fare_amount) AS avg_fare, avg(tip_percentage) AS avg_tip_pct FROM s GROUP BY 1",
        "avg_fare avg_tip_pct",
    ),
    "silver_by_period": _query(
        "SELECT time_period, count(*) AS trips, avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance FROM s GROUP BY 1",
        "avg_fare avg_distance",
    ),
    "silver_by_weekend": _query(
        "SELECT is_weekend, count(*) AS trips, avg(fare_amount) AS avg_fare, avg(tip_percentage) AS avg_tip_pct, avg(trip_distance) AS avg_distance FROM s GROUP BY 1",
        "avg_fare avg_tip_pct avg_distance",
    ),
    "top_routes_by_count": _query(
        "SELECT PULocationID, DOLocationID, count(*) AS trip_count FROM s GROUP BY 1, 2 ORDER BY trip_count DESC, PULocationID, DOLocationID LIMIT 10"
    ),
    "kpi_overall": _query(
        """SELECT count(*) AS total_trips, sum(total_amount) AS total_revenue, sum(trip_distance) AS total_distance, sum(passenger_count) AS total_passengers,
        avg(total_amount) AS avg_revenue_per_trip, avg(trip_distance) AS avg_distance_per_trip, avg(trip_duration_minutes) AS avg_duration_minutes,
        avg(tip_percentage) AS avg_tip_percentage, count(DISTINCT PULocationID) AS unique_pickup_locations, count(DISTINCT DOLocationID) AS unique_dropoff_locations FROM s""",
        "total_revenue total_distance total_passengers avg_revenue_per_trip avg_distance_per_trip avg_duration_minutes avg_tip_percentage",
    ),
    "mini_hourly": _query(
        "SELECT pickup_hour, count(*) AS trip_count, avg(total_amount) AS avg_amount, sum(total_amount) AS total_revenue FROM s GROUP BY 1",
        "avg_amount total_revenue",
    ),
    "mini_location": _query(
        "SELECT PULocationID, count(*) AS pickup_count, avg(trip_distance) AS avg_distance FROM s GROUP BY 1", "avg_distance"
    ),
    "mini_summary": _query(
        "SELECT count(*) AS total_trips, sum(total_amount) AS total_revenue, avg(total_amount) AS avg_fare, max(trip_distance) AS max_distance FROM s",
        "total_revenue avg_fare max_distance",
    ),
    "gold_daily": _query("SELECT * FROM daily", _DAILY_DOUBLES),
    "gold_daily_lite": _query(_DAILY_BASIC, _DAILY_BASIC_DOUBLES),
    "gold_hourly": _query("SELECT * FROM hourly", _HOURLY_DOUBLES),
    "gold_hourly_lite": _query(
        "SELECT pickup_hour, is_weekend, trip_date, total_trips, avg_revenue_per_trip, avg_distance, avg_duration FROM hourly",
        "avg_revenue_per_trip avg_distance avg_duration",
    ),
    "gold_location": _query("SELECT * FROM location", _LOCATION_DOUBLES),
    "gold_location_neutral": _query(
        """SELECT location_id, pickup_count AS trip_count, avg_distance_from_location AS avg_distance, avg_revenue_from_location AS avg_revenue,
        avg_tip_from_location AS avg_tip, unique_destinations AS unique_counterparts, location_type FROM location""",
        "avg_distance avg_revenue avg_tip",
    ),
    "gold_vendor": _query("SELECT * FROM vendor", _VENDOR_DOUBLES),
    "gold_payment": _query(
        "SELECT * FROM payment",
        "total_revenue avg_amount avg_tip avg_tip_percentage avg_fare tip_percentage_std revenue_share",
    ),
    "gold_time_series": _query(
        "SELECT * FROM series", "revenue avg_distance avg_duration hour_sin hour_cos day_sin day_cos"
    ),
    "gold_route": _query(
        "SELECT * FROM route",
        "total_revenue avg_revenue_per_trip avg_distance avg_duration avg_speed avg_tip_percentage revenue_std weekend_ratio revenue_per_mile route_efficiency_score",
    ),
    "gold_financial": _query(
        "SELECT * FROM financial",
        "gross_revenue fare_revenue tip_revenue tolls_revenue extra_revenue total_miles total_hours total_passengers avg_revenue_per_trip"
        " avg_miles_per_trip avg_tip_rate revenue_per_mile trips_per_day revenue_per_day revenue_growth_rate trips_growth_rate",
    ),
    "vendor_rollup": _query(
        """SELECT vendor_name, CAST(sum(total_trips) AS BIGINT) AS total_trips, sum(total_revenue) AS total_revenue, avg(avg_tip_percentage) AS avg_tip_pct
        FROM vendor GROUP BY 1""",
        "total_revenue avg_tip_pct",
    ),
    "hour_profile": _query(
        "SELECT pickup_hour, avg(total_trips) AS avg_trips_per_hour, avg(avg_revenue_per_trip) AS avg_revenue FROM hourly GROUP BY 1",
        "avg_trips_per_hour avg_revenue",
    ),
    "weekend_daily": _query(
        """SELECT is_weekend, avg(total_trips) AS avg_daily_trips, avg(total_revenue) AS avg_daily_revenue, avg(avg_tip_percentage) AS avg_tip_pct,
        sum(total_distance) / sum(total_trips) AS avg_distance FROM daily GROUP BY 1""",
        "avg_daily_trips avg_daily_revenue avg_tip_pct avg_distance",
    ),
    "top_revenue_days": _query(
        "SELECT trip_date, total_revenue, total_trips, pickup_dayname FROM daily ORDER BY total_revenue DESC, trip_date LIMIT 5", "total_revenue"
    ),
    "top_profitable_routes": _query(
        """SELECT PULocationID, DOLocationID, trip_count, total_revenue, avg_revenue_per_trip, revenue_per_mile FROM route
        ORDER BY total_revenue DESC, PULocationID, DOLocationID LIMIT 10""",
        "total_revenue avg_revenue_per_trip revenue_per_mile",
    ),
    "monthly_growth": _query(
        "SELECT month_year, total_trips, gross_revenue, trips_growth_rate, revenue_growth_rate FROM financial",
        "gross_revenue trips_growth_rate revenue_growth_rate",
    ),
    "gold_consistency": _query(
        """SELECT silver_total, daily_total, abs(silver_total - daily_total) AS difference, abs(silver_total - daily_total) < 100 AS consistent
        FROM (SELECT (SELECT count(*) FROM s) AS silver_total, (SELECT CAST(sum(total_trips) AS BIGINT) FROM daily) AS daily_total)"""
    ),
    "gold_validation": _query(_validation()),
    "view_kpi_dashboard": _query(
        """SELECT trip_date, pickup_dayname, is_weekend, total_trips, total_revenue, avg_fare_amount, avg_tip_percentage, avg_trip_distance,
        avg_trip_duration, revenue_per_mile, '2024-01-01 00:00:00' AS processing_timestamp FROM daily""",
        "total_revenue avg_fare_amount avg_tip_percentage avg_trip_distance avg_trip_duration revenue_per_mile",
    ),
    "view_hourly_trends": _query(
        """SELECT pickup_hour, pickup_dayname, is_weekend, avg(total_trips) AS avg_trips, avg(avg_revenue_per_trip) AS avg_revenue,
        avg(avg_tip_percentage) AS avg_tip_pct FROM hourly GROUP BY 1, 2, 3""",
        "avg_trips avg_revenue avg_tip_pct",
    ),
    "view_vendor_dashboard": _query(
        """SELECT vendor_name, month_year, total_trips, total_revenue, market_share_trips, market_share_revenue, avg_tip_percentage, outlier_rate
        FROM vendor""",
        "total_revenue market_share_trips market_share_revenue avg_tip_percentage outlier_rate",
    ),
    "view_run_monitoring": _query(
        f"""SELECT execution_id, pipeline_name, {_text('start_time')}, {_text('end_time')}, status, stage, records_processed,
        execution_time_minutes, quality_score, error_message, CASE WHEN status IN ('SUCCESS', 'FAILED') THEN status ELSE 'PENDING' END AS status_icon FROM log""",
        "execution_time_minutes quality_score",
    ),
    "latest_runs": _query(
        f"""SELECT execution_id, pipeline_name, {_text('start_time')}, {_text('end_time')}, status, stage, records_processed,
        execution_time_minutes, quality_score, error_message, status AS status_icon FROM (SELECT * FROM log ORDER BY start_time DESC, execution_id DESC LIMIT 10)""",
        "execution_time_minutes quality_score",
    ),
    "view_quality_metrics": _query(
        """SELECT strftime(start_time, '%Y-%m-%d') AS execution_date, count(*) AS total_executions,
        count(*) FILTER (WHERE status = 'SUCCESS') AS successful_executions, count(*) FILTER (WHERE status = 'FAILED') AS failed_executions,
        avg(quality_score) AS avg_quality_score, avg(execution_time_minutes) AS avg_execution_time,
        CAST(sum(records_processed) AS BIGINT) AS total_records_processed FROM log GROUP BY 1""",
        "avg_quality_score avg_execution_time",
    ),
    "health_check": _query(_health(12), "avg_quality_score failure_rate hours_since_last_run"),
    "health_check_stale": _query(_health(50), "avg_quality_score failure_rate hours_since_last_run"),
    "backfill_summary": _query(
        """SELECT count(*) AS total_months, count(*) FILTER (WHERE status = 'SUCCESS') AS successful_months,
        count(*) FILTER (WHERE status = 'FAILED') AS failed_months FROM log"""
    ),
    "month_load_log": _query(
        """SELECT pipeline_name, status, stage, records_processed, records_bronze, records_silver, records_gold, error_message, quality_score FROM log""",
        "quality_score",
    ),
    "month_load_daily": _query("SELECT * FROM fdaily", _DAILY_DOUBLES),
    "month_load_hourly": _query("SELECT * FROM fhourly", "avg_revenue_per_trip avg_distance avg_duration avg_tip_percentage avg_speed"),
    "unreadable_values": _query(
        f"""SELECT ingestion_month, 'month=' || ingestion_month AS source_file, 'passenger_count' AS column_name, 'n/a' AS raw_value, 'no double' AS reason,
        count(*) AS n_values FROM files WHERE ingestion_month >= {_SECOND} AND payment_type = 3 GROUP BY 1"""
    ),
    "widened_column": _query(
        f"""SELECT ingestion_month, CAST(ingestion_month[:4] AS INTEGER) AS ingestion_year,
        'load' || CASE WHEN ingestion_month < {_SECOND} THEN 1 WHEN ingestion_month = {_AGAIN} THEN 3 ELSE 2 END || '_' || ingestion_month AS processing_execution_id,
        'bigint' AS type, count(*) AS n_rows, min(meter) AS least, max(meter) AS greatest
        FROM (SELECT *, CAST(PULocationID AS BIGINT) + CASE WHEN ingestion_month < {_SECOND} THEN 0 ELSE 3000000000 END AS meter FROM files) GROUP BY 1"""
    ),
    "table_statistics": _query(_statistics()),
    "compacted_partitions": _query(
        f"""SELECT ingestion_month AS month, CASE WHEN late THEN parts ELSE 1 END AS files_before, CAST(NOT late OR parts = 1 AS BIGINT) AS files_kept,
        CAST(1 AS BIGINT) AS files_after, n_rows, fares FROM (
          SELECT ingestion_month, ingestion_month >= {_SECOND} AS late, count(DISTINCT payment_type % 3) AS parts, count(*) AS n_rows, sum(fare_amount) AS fares
          FROM b GROUP BY 1)""",
        "fares",
    ),
    "event_report": _query(_EVENTS, "total"),
    "peak_hours": _query(
        """SELECT * FROM (SELECT 'morning_peak' AS kind, pickup_hour, avg(total_trips) AS avg_trips FROM hourly WHERE pickup_hour < 12 GROUP BY 2 ORDER BY avg_trips DESC, pickup_hour LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'evening_peak', pickup_hour, avg(total_trips) AS a FROM hourly WHERE pickup_hour >= 12 GROUP BY 2 ORDER BY a DESC, pickup_hour LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'trough', pickup_hour, avg(total_trips) AS a FROM hourly GROUP BY 2 ORDER BY a, pickup_hour LIMIT 1)""",
        "avg_trips",
    ),
    "vendor_share_total": _query(
        """SELECT VendorID, vendor_name, count(*) AS total_trips, avg(total_amount) AS avg_revenue, avg(tip_percentage) AS avg_tip_pct,
        count(*) / (SELECT count(*) FROM s) * CAST(100 AS DOUBLE) AS market_share FROM s GROUP BY 1, 2""",
        "avg_revenue avg_tip_pct market_share",
    ),
    "top_pickups_ranked": _query(
        """SELECT CAST(row_number() OVER (ORDER BY total_trips DESC, PULocationID) AS INTEGER) AS rank, * FROM
        (SELECT PULocationID, count(*) AS total_trips, count(*) / (SELECT count(*) FROM s) * CAST(100 AS DOUBLE) AS pct_of_total
        FROM s GROUP BY 1 ORDER BY total_trips DESC, PULocationID LIMIT 10)""",
        "pct_of_total",
    ),
    "payment_mix": _query(
        """SELECT payment_type, payment_type_desc, count(*) AS total_trips, avg(tip_amount) AS avg_tip, avg(tip_percentage) AS avg_tip_pct,
        avg(total_amount) AS avg_revenue, count(*) / (SELECT count(*) FROM s) * CAST(100 AS DOUBLE) AS pct_of_trips FROM s GROUP BY 1, 2""",
        "avg_tip avg_tip_pct avg_revenue pct_of_trips",
    ),
    "tip_by_daypart": _query(
        """SELECT CASE WHEN pickup_hour < 6 THEN '00-06' WHEN pickup_hour < 12 THEN '06-12' WHEN pickup_hour < 18 THEN '12-18' ELSE '18-24' END AS daypart,
        count(*) AS trips, avg(tip_percentage) AS avg_tip_pct FROM s GROUP BY 1""",
        "avg_tip_pct",
    ),
    "tip_by_distance": _query(
        """SELECT CASE WHEN trip_distance < 1 THEN '<1' WHEN trip_distance < 5 THEN '1-5' WHEN trip_distance <= 10 THEN '5-10' ELSE '>10' END AS distance_class,
        count(*) AS trips, avg(tip_percentage) AS avg_tip_pct FROM s GROUP BY 1""",
        "avg_tip_pct",
    ),
    "by_day_of_week": _query(
        """SELECT pickup_dayofweek, count(*) AS total_trips, avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct, pickup_dayname
        FROM s GROUP BY pickup_dayofweek, pickup_dayname""",
        "avg_distance avg_tip_pct",
    ),
    "anomalous_days": _query(
        """SELECT * FROM (SELECT trip_date, pickup_dayname, total_trips, avg(total_trips) OVER w AS usual_trips,
        (total_trips - avg(total_trips) OVER w) / avg(total_trips) OVER w * CAST(100 AS DOUBLE) AS trips_deviation_pct,
        (avg_tip_percentage - avg(avg_tip_percentage) OVER w) / avg(avg_tip_percentage) OVER w * CAST(100 AS DOUBLE) AS tip_deviation_pct
        FROM daily WINDOW w AS (PARTITION BY pickup_dayname)) WHERE abs(trips_deviation_pct) >= 15""",
        "usual_trips trips_deviation_pct tip_deviation_pct",
    ),
    "growth_projection": _query(
        """SELECT strftime(strptime(last_month || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH * months_ahead, '%Y-%m') AS month_year, months_ahead,
        avg_trips_growth, avg_revenue_growth, last_trips * pow(1 + avg_trips_growth / 100, months_ahead) AS projected_trips,
        last_revenue * pow(1 + avg_revenue_growth / 100, months_ahead) AS projected_revenue
        FROM (SELECT max(month_year) AS last_month, arg_max(total_trips, month_year) AS last_trips, arg_max(gross_revenue, month_year) AS last_revenue,
          avg(trips_growth_rate) AS avg_trips_growth, avg(revenue_growth_rate) AS avg_revenue_growth FROM financial),
        (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS months_ahead)""",
        "avg_trips_growth avg_revenue_growth projected_trips projected_revenue",
    ),
    "monthly_alerts": _query(
        """SELECT month_year, total_trips, avg_tip_pct, outlier_pct, avg_speed, trips_change, tip_change, outlier_change,
        coalesce(trips_change < -10 AND lag(trips_change) OVER (ORDER BY month_year) < -10, false) AS alert_trips,
        coalesce(tip_change < -15, false) AS alert_tips, coalesce(outlier_change > 20, false) AS alert_outliers, coalesce(avg_speed < 10, false) AS alert_speed
        FROM (SELECT *, (total_trips - lag(total_trips) OVER w) / lag(total_trips) OVER w * CAST(100 AS DOUBLE) AS trips_change,
          (avg_tip_pct - lag(avg_tip_pct) OVER w) / nullif(lag(avg_tip_pct) OVER w, 0) * CAST(100 AS DOUBLE) AS tip_change,
          (outlier_pct - lag(outlier_pct) OVER w) / nullif(lag(outlier_pct) OVER w, 0) * CAST(100 AS DOUBLE) AS outlier_change
          FROM (SELECT month AS month_year, count(*) AS total_trips, avg(tip_percentage) AS avg_tip_pct,
            count(*) FILTER (WHERE has_outlier) / count(*) * CAST(100 AS DOUBLE) AS outlier_pct, avg(avg_speed_mph) AS avg_speed FROM f GROUP BY 1)
          WINDOW w AS (ORDER BY month_year))""",
        "avg_tip_pct outlier_pct avg_speed trips_change tip_change outlier_change",
    ),
    "weekly_variation": _query(
        """SELECT * EXCLUDE (follows), CASE WHEN follows THEN (total_trips - lag(total_trips) OVER w) / lag(total_trips) OVER w * CAST(100 AS DOUBLE) END AS trips_change,
        CASE WHEN follows THEN (total_revenue - lag(total_revenue) OVER w) / nullif(lag(total_revenue) OVER w, 0) * CAST(100 AS DOUBLE) END AS revenue_change
        FROM (SELECT *, CAST(lag(week_start) OVER (ORDER BY week_start) AS DATE) + 7 = CAST(week_start AS DATE) AS follows FROM (
          SELECT strftime(date_trunc('week', tpep_pickup_datetime), '%Y-%m-%d') AS week_start, count(*) AS total_trips, sum(total_amount) AS total_revenue,
          avg(tip_percentage) AS avg_tip_pct, count(DISTINCT PULocationID) AS locations_served FROM s GROUP BY 1))
        WINDOW w AS (ORDER BY week_start)""",
        "total_revenue avg_tip_pct trips_change revenue_change",
    ),
    "monthly_distance_growth": _query(
        """SELECT month_year, avg_miles_per_trip, (avg_miles_per_trip - lag(avg_miles_per_trip) OVER w) / nullif(lag(avg_miles_per_trip) OVER w, 0)
        * CAST(100 AS DOUBLE) AS distance_growth_rate FROM financial WINDOW w AS (ORDER BY month_year)""",
        "avg_miles_per_trip distance_growth_rate",
    ),
    "efficiency_metrics": _query(
        "SELECT avg(avg_speed_mph) AS avg_speed, avg(trip_duration_minutes) AS avg_duration, avg(passenger_count) AS avg_passengers FROM s",
        "avg_speed avg_duration avg_passengers",
    ),
}
