"""Hand-made trips for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from curbline.schema import DROPOFF, PICKUP, TRIP_COLUMNS, TRIP_SCHEMA

START = datetime(2024, 1, 1, 10, 0, 0)

# A trip that passes every check and has no flag.
PLAIN = {
    "VendorID": 1,
    PICKUP: START,
    DROPOFF: START + timedelta(minutes=30),
    "passenger_count": 1.0,
    "trip_distance": 5.0,
    "PULocationID": 132,
    "DOLocationID": 7,
    "payment_type": 1,
    "fare_amount": 20.0,
    "tip_amount": 3.0,
    "total_amount": 25.0,
}


def trip(seconds: float | None = None, **changes) -> dict:
    """PLAIN with changes; ``seconds`` moves the dropoff to so long after the pickup."""
    made = PLAIN | changes
    if seconds is not None:
        made[DROPOFF] = made[PICKUP] + timedelta(seconds=seconds)
    return made


def frame(spark: SparkSession, trips: list[dict]) -> DataFrame:
    rows = [tuple(made.get(name) for name in TRIP_COLUMNS) for made in trips]
    return spark.createDataFrame(rows, TRIP_SCHEMA)
