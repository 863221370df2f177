from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from farelane.model import TRIP_SCHEMA  # noqa: E402
from farelane.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    folder = tmp_path_factory.mktemp("spark")
    session = get_session(
        "tests",
        {
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULT_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2023, 1, 2, 8, 0),
    "tpep_dropoff_datetime": datetime(2023, 1, 2, 8, 30),
    "passenger_count": 1.0,
    "trip_distance": 5.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 4.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 25.3,
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
}


def trip(**changes) -> tuple:
    """One trip row; ``minutes`` sets the dropoff relative to the pickup."""
    row = dict(DEFAULT_TRIP)
    minutes = changes.pop("minutes", None)
    row |= changes
    if minutes is not None:
        row["tpep_dropoff_datetime"] = row["tpep_pickup_datetime"] + timedelta(minutes=minutes)
    return tuple(row[name] for name in TRIP_SCHEMA.names)


MONDAY = datetime(2023, 1, 2)

# Row number -> trip; every row differs from row 1 in the stated fields only.
EDGE_CASES = {
    1: trip(),
    2: trip(
        VendorID=2,
        tpep_pickup_datetime=datetime(2023, 1, 1, 23, 50),
        minutes=20,
        trip_distance=2.0,
        payment_type=2,
        fare_amount=10.0,
        tip_amount=0.0,
        total_amount=11.3,
    ),
    3: trip(minutes=0),
    4: trip(tpep_pickup_datetime=MONDAY.replace(hour=10), minutes=-30),
    5: trip(minutes=59 / 60, trip_distance=0.1),
    6: trip(minutes=1, trip_distance=1.0),
    7: trip(passenger_count=None),
    8: trip(trip_distance=0.0, fare_amount=0.0, tip_amount=0.0, total_amount=0.0, PULocationID=5, DOLocationID=6),
    9: trip(VendorID=3),
    10: trip(RatecodeID=99.0, payment_type=0),
    11: trip(fare_amount=1000.0, total_amount=1500.0),
    12: trip(minutes=6, trip_distance=20.1),
    13: trip(PULocationID=0),
    14: trip(minutes=1440),
    15: trip(fare_amount=1000.01),
    16: trip(),
}


@pytest.fixture(scope="session")
def edge(spark):
    """The edge cases with their row number."""
    rows = [(number, *row) for number, row in EDGE_CASES.items()]
    columns = ["row int"] + [f"{f.name} {f.dataType.simpleString()}" for f in TRIP_SCHEMA]
    return spark.createDataFrame(rows, ", ".join(columns)).cache()
