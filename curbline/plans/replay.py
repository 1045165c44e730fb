"""Split one day of trips into hourly batches and publish them in the landing folder.

A day is written to a staging folder beside the landing folder, where no stream looks. Its manifest
goes in last, then one rename publishes all of it. A day has landed when its manifest is there.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import storage
from curbline.functions.labels import hour_in_path
from curbline.operators.days import one_day, two_digit_hour
from curbline.schema import PICKUP, TRIP_SCHEMA

# Scans and streams pass over names that begin so.
MANIFEST = "_manifest.json"


def day_folder(landing: str, day: date) -> str:
    return f"{landing.rstrip('/')}/day={day.isoformat()}"


def staging_folder(landing: str) -> str:
    """Beside the landing folder, and so in the same file system."""
    return f"{landing.rstrip('/')}.staging"


def has_landed(spark: SparkSession, landing: str, day: date) -> bool:
    return storage.exists(spark, f"{day_folder(landing, day)}/{MANIFEST}")


def manifest(spark: SparkSession, landing: str, day: date) -> dict:
    """What was published: the day, and ``hours`` with the trips of each."""
    return json.loads(storage.read_text(spark, f"{day_folder(landing, day)}/{MANIFEST}"))


def write_hour_batches(trips: DataFrame, day: date, landing: str, replace: bool = False) -> None:
    """Publish the trips of ``day`` under ``landing/day=.../hour=00`` to ``hour=23``.

    Nothing outside the day's folder is touched. A day that has landed is refused, since a
    stream may have taken its files and would take new ones again; ``replace`` is for a day
    whose tables are reset as well. What a landing that broke off has left, in the staging folder or
    as a day without manifest, is removed, and the day lands.

    One pass over the day. The rebalance brings an hour's rows together, so that an
    hour is one file, and splits an hour that outgrows
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over several tasks and files.
    An hour without trips gets no folder. Stores without folders rename file by file: there,
    streams should look only at days with a manifest.
    """
    spark, target = trips.sparkSession, day_folder(landing, day)
    if has_landed(spark, landing, day) and not replace:
        raise ValueError(f"{day} has landed; reset its tables and replace it")
    name = f"day={day.isoformat()}"
    for left in storage.names_in(spark, staging_folder(landing)):
        if left.startswith(f"{name}."):
            storage.remove(spark, f"{staging_folder(landing)}/{left}")
    staged = f"{staging_folder(landing)}/{name}.{uuid.uuid4().hex}"
    batches = one_day(trips, PICKUP, day).withColumn("hour", two_digit_hour(PICKUP))
    batches.hint("rebalance", "hour").write.partitionBy("hour").parquet(staged)
    counts = hour_batch_counts(spark, staged).where("hour IS NOT NULL AND trips > 0").collect()
    hours = {f"{row['hour']:02d}": row["trips"] for row in counts}
    published = {"day": day.isoformat(), "trips": sum(hours.values()), "hours": hours}
    storage.write_text(spark, f"{staged}/{MANIFEST}", json.dumps(published, indent=1))
    storage.remove(spark, target)
    storage.rename(spark, staged, target)


def hour_batch_counts(spark: SparkSession, landing: str) -> DataFrame:
    """Trips per hour of a landing folder, or of one day of it, hours without trips included.

    The row with NULL ``hour`` is the total. The counts need no column of the files, so no
    file's types matter, and an hour is found by its path, however it is spelled.
    """
    written = (
        spark.read.schema(TRIP_SCHEMA)
        .option("recursiveFileLookup", True)
        .parquet(landing)
        .groupBy(hour_in_path(F.col("_metadata.file_path")).alias("hour"))
        .agg(F.count(F.lit(1)).alias("found"))
    )
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    return (
        hours.join(written, "hour", "left")
        .rollup("hour")
        .agg(F.coalesce(F.sum("found"), F.lit(0)).alias("trips"))
        .orderBy(F.col("hour").asc_nulls_last())
    )
