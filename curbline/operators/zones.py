"""The zone dimension and the join to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.schema import ZONE_COLUMNS


def zone_dimension(lookup: DataFrame) -> DataFrame:
    """Rename and cast the lookup's columns, found by header name."""
    return lookup.select(
        *(F.col(header).cast(kind).alias(name) for header, (name, kind) in ZONE_COLUMNS.items())
    )


def require_unique_zones(zones: DataFrame) -> DataFrame:
    """Return ``zones``, or fail if a location has two rows, which would double its KPIs."""
    counts = zones.filter(F.col("location_id").isNotNull()).groupBy("location_id").count()
    repeated = counts.filter(F.col("count") > 1).select("location_id").take(5)
    if repeated:
        ids = ", ".join(str(row.location_id) for row in repeated)
        raise ValueError(f"zone lookup repeats location ids: {ids}")
    return zones


def add_zone_names(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join on ``location_id``; a location the lookup lacks keeps NULL names.

    No hint: Spark broadcasts the lookup while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges beyond that.
    """
    return rows.join(zones, "location_id", "left")
