"""Column names and types of the trip and zone data, and the step that applies them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The record layout of the published trip files.
TRIP_COLUMNS = {
    "VendorID": "long",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "long",
    "DOLocationID": "long",
    "payment_type": "long",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
}

# Zone lookup header -> (name, type) in the zone dimension.
ZONE_COLUMNS = {
    "LocationID": ("location_id", "long"),
    "Borough": ("borough", "string"),
    "Zone": ("zone_name", "string"),
    "service_zone": ("service_zone", "string"),
}

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def struct_of(columns: Mapping[str, str]) -> StructType:
    """A nullable StructType from a name -> type mapping."""
    struct = StructType()
    for name, kind in columns.items():
        struct.add(name, kind)
    return struct


TRIP_SCHEMA = struct_of(TRIP_COLUMNS)


def conform(rows: DataFrame, columns: Mapping[str, str] = TRIP_COLUMNS) -> DataFrame:
    """Cast ``rows`` to ``columns``; a column the input lacks becomes a typed NULL.

    Trip files of different months store counts as integers or doubles and times
    without a zone. A scan with a declared schema rejects some of these, so files of
    unknown age are read with their own types and cast here. Names match without
    regard to case. Columns outside ``columns`` are left out.
    """
    present = {name.lower(): name for name in rows.columns}
    return rows.select(
        *(
            (F.col(present[name.lower()]) if name.lower() in present else F.lit(None))
            .cast(kind)
            .alias(name)
            for name, kind in columns.items()
        )
    )
