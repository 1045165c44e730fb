"""Landing files -> bronze table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.schema import TRIP_COLUMNS, conform
from curbline.sources.files import file_stream
from curbline.streaming.ingest import INGEST_COLUMNS, with_ingest_columns
from curbline.streaming.tables import drain_to_table

# The columns of a bronze sample.
SAMPLE_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "_ingest_timestamp",
    "_batch_hour",
]


def ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    file_columns: Mapping[str, str] = TRIP_COLUMNS,
    source_options: Mapping[str, str] | None = None,
    **sink_options,
) -> None:
    """Append the landing files the table has not seen yet.

    ``file_columns`` names the types the files were written with, where these are not
    the trip schema's; the table gets the trip schema either way.
    """
    files = file_stream(spark, landing, file_columns, **(source_options or {}))
    rows = conform(with_ingest_columns(files), TRIP_COLUMNS | INGEST_COLUMNS)
    drain_to_table(rows, table, **sink_options)


def batch_hour_counts(bronze: DataFrame) -> DataFrame:
    """Trips per landing hour; NULL for files outside an hour folder."""
    return (
        bronze.groupBy("_batch_hour")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("_batch_hour").asc_nulls_first())
    )


def sample(bronze: DataFrame, rows: int = 10) -> DataFrame:
    """A few arbitrary rows, for looking at."""
    return bronze.select(SAMPLE_COLUMNS).limit(rows)
