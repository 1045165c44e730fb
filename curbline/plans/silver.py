"""Bronze table -> silver table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from curbline.operators.refine import refine
from curbline.sources.files import table_stream
from curbline.streaming.tables import drain_to_table

# The columns of a silver sample.
SAMPLE_COLUMNS = [
    "tpep_pickup_datetime",
    "trip_distance",
    "trip_duration_mins",
    "speed_mph",
    "fare_amount",
    "tip_pct",
    "payment_type_desc",
    "time_of_day",
    "is_anomaly",
]


def refine_table(
    spark: SparkSession,
    bronze: str,
    silver: str,
    source_options: Mapping[str, str] | None = None,
    **sink_options,
) -> None:
    """Append refined trips for the bronze rows the silver table has not seen yet."""
    rows = table_stream(spark, bronze, **(source_options or {}))
    drain_to_table(refine(rows), silver, **sink_options)


def sample(silver: DataFrame, rows: int = 10) -> DataFrame:
    """A few arbitrary rows, for looking at."""
    return silver.select(SAMPLE_COLUMNS).limit(rows)
