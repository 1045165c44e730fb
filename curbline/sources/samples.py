"""Trips, zones and events over the test tables.

The test tables hold no trips. ``TRIP_FIELDS`` maps ``lineitem`` to trips so that
every quality check and anomaly rule has rows on both sides; the expressions mean the
same in Spark SQL and DuckDB, and the checks in ``__spark_entry__`` use them too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.schema import DROPOFF, PICKUP, conform

_PICKUP_SECOND = "CAST(1704067200 + (l_orderkey * 7919 + l_linenumber * 613) % 86400 AS BIGINT)"

TRIP_FIELDS = {
    "VendorID": "CAST(l_suppkey % 2 + 1 AS BIGINT)",
    "pu_sec": _PICKUP_SECOND,
    "do_sec": (
        f"{_PICKUP_SECOND} + CAST(CASE WHEN l_partkey % 97 = 0 THEN -60"
        " WHEN l_partkey % 89 = 0 THEN 90000 WHEN l_partkey % 83 = 0 THEN 20000"
        " ELSE 120 + (l_partkey * 37 + l_linenumber * 11) % 3600 END AS BIGINT)"
    ),
    "passenger_count": (
        "CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN l_orderkey % 47 = 0 THEN 0.0"
        " ELSE CAST(l_linenumber AS DOUBLE) END"
    ),
    "trip_distance": (
        "CASE WHEN l_partkey % 43 = 0 THEN 0.0 WHEN l_partkey % 41 = 0 THEN 400.0"
        " ELSE l_quantity / 4 END"
    ),
    "PULocationID": "CAST(CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE l_suppkey END AS BIGINT)",
    "payment_type": "CAST(l_orderkey % 6 AS BIGINT)",
    "fare_amount": (
        "CASE WHEN l_orderkey % 71 = 0 THEN 0.0"
        " WHEN l_orderkey % 73 = 0 THEN -l_extendedprice / 1000"
        " WHEN l_orderkey % 79 = 0 THEN NULL ELSE l_extendedprice / 1000 END"
    ),
    "tip_amount": "l_extendedprice / 1000 * l_discount",
    "total_amount": (
        "CASE WHEN l_orderkey % 67 = 0 THEN 1500.0 ELSE l_extendedprice / 1000 * (1 + l_tax) END"
    ),
}

# The same trips over three days, some without a pickup or dropoff time.
_EDGE_PICKUP = (
    f"{_PICKUP_SECOND} + CAST((l_orderkey % 3 - 1) * 86400 AS BIGINT)"
)
EDGE_FIELDS = TRIP_FIELDS | {
    "pu_sec": f"CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE {_EDGE_PICKUP} END",
    "do_sec": (
        "CASE WHEN l_partkey % 103 = 0 THEN NULL ELSE"
        f" {TRIP_FIELDS['do_sec'].replace(_PICKUP_SECOND, _EDGE_PICKUP)} END"
    ),
}

EVENT_COLUMNS = {
    "event_id": "long",
    "ts": "timestamp",
    "user_id": "long",
    "event_type": "string",
    "value": "double",
    "props": "string",
}


def trips(
    spark: SparkSession, sf_dir: str, trip_fields: Mapping[str, str] = TRIP_FIELDS
) -> DataFrame:
    """All of ``lineitem`` as trips with the full trip schema."""
    fields = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        *(f"{expression} AS {name}" for name, expression in trip_fields.items())
    )
    return conform(
        fields.withColumns(
            {PICKUP: F.timestamp_seconds("pu_sec"), DROPOFF: F.timestamp_seconds("do_sec")}
        )
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` and ``region`` under the headers of the zone lookup file."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("service_zone"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")
