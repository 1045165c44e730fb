"""Event-time windows with a watermark: closed windows are emitted, later rows dropped.

A window is emitted once the watermark (latest event time seen, less the delay) has
passed its end. The last windows stay open until newer rows arrive. ``open_windows`` reads them from
the state of the stream, as they are after its last batch: with the emitted ones they are all
windows, and rows that come afterwards still count. Rows that came behind the watermark are in
``late_rows``: emitted, open and late rows are all rows.

A backfill that is over can be closed for good: a stream ``with_closing`` also reads a folder of
marker rows, and ``close_windows`` puts one there whose time is past all windows. The
marker moves the watermark and is left out of the results. What arrives later for a time
before it is late. Groups are combined on the map side before the state store, whose size is
the number of open windows times the other keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from curbline.operators.refine import FLAG_COLUMNS, LATE_BY
from curbline.operators.totals import select_kpis, total_names, total_up
from curbline.schema import PICKUP
from curbline.sources.files import NEVER_TOO_OLD
from curbline.streaming.archive import one_spelling, taken_files

MARKER = "_closes_windows"

# The KPIs of a window.
WINDOW_KPIS = [
    "total_trips",
    "total_revenue_usd",
    "avg_fare_usd",
    "avg_distance_miles",
    "avg_tip_pct",
    "avg_duration_mins",
    "credit_card_trips",
    "cash_trips",
    "anomaly_count",
    "avg_speed_mph",
]


def with_closing(stream: DataFrame, folder: str) -> DataFrame:
    """``stream`` and the markers of ``folder``, which is made if it is missing."""
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("append").parquet(folder)
    markers = spark.readStream.schema(stream.schema).option("maxFileAge", NEVER_TOO_OLD)
    return stream.withColumn(MARKER, F.lit(False)).unionByName(
        markers.parquet(folder).withColumn(MARKER, F.lit(True))
    )


def close_windows(stream: DataFrame, folder: str, time: str, at: datetime) -> None:
    """Put a marker of time ``at`` into ``folder``; the next drain emits every window that ends by
    ``at`` less the delay of the watermark. ``stream`` is the one without markers."""
    row = [tuple(at if name == time else None for name in stream.columns)]
    marker = stream.sparkSession.createDataFrame(row, stream.schema)
    marker.coalesce(1).write.mode("append").parquet(folder)


def _watermarked(stream: DataFrame, time: str, late_by: str) -> DataFrame:
    """Markers count for the watermark and go then. The filter names the time, or Spark would move
    it before the watermark."""
    marked = stream.withWatermark(time, late_by)
    if MARKER not in stream.columns:
        return marked
    return marked.filter(F.col(time).isNull() | ~F.col(MARKER)).drop(MARKER)


def windowed(
    stream: DataFrame,
    time: str,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    width: str = "1 hour",
    late_by: str = LATE_BY,
) -> DataFrame:
    """Named ``aggregates`` per tumbling window of ``time`` and ``keys``."""
    return (
        _watermarked(stream, time, late_by)
        .groupBy(F.window(time, width), *keys)
        .agg(*(value.alias(name) for name, value in aggregates.items()))
        .select(F.col("window.start").alias("window_start"), *keys, *aggregates)
    )


def trip_windows(refined: DataFrame, width: str = "1 hour", late_by: str = LATE_BY) -> DataFrame:
    """Trip KPIs per pickup window of a refined stream."""
    totals = total_up(_watermarked(refined, PICKUP, late_by), [F.window(PICKUP, width)])
    return select_kpis(totals, [F.col("window.start").alias("window_start")], WINDOW_KPIS)


def open_windows(
    spark: SparkSession, checkpoint: str, keys: Sequence[str], aggregates: Sequence[str]
) -> DataFrame:
    """What ``windowed`` would give for the windows still open after the last batch of its stream.

    ``aggregates`` are the names in their order there. Each must be kept in one value, as counts, sums,
    least and largest values are; means are not.
    """
    state = spark.read.format("statestore").load(checkpoint)
    held = state.schema["value"].dataType.fields
    if len(held) != len(aggregates):
        raise ValueError(f"{len(aggregates)} aggregates are kept in {len(held)} values")
    named = StructType([StructField(n, f.dataType) for n, f in zip(aggregates, held, strict=True)])
    return state.select(
        F.col("key.window.start").alias("window_start"),
        *(F.col(f"key.{name}").alias(name) for name in keys),
        F.col("value").cast(named).alias("value"),
    ).select("window_start", *keys, "value.*")


def open_trip_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``trip_windows`` of the windows still open."""
    # The state holds the totals that the KPIs need, and trips per flag are not among them.
    unused = {f"{flag}_trips" for flag in FLAG_COLUMNS}
    totals = open_windows(spark, checkpoint, [], [n for n in total_names() if n not in unused])
    return select_kpis(totals, ["window_start"], WINDOW_KPIS)


def late_rows(
    rows: DataFrame, checkpoint: str, time: str, width: str = "1 hour", late_by: str = LATE_BY
) -> DataFrame:
    """The rows that the windowed stream with this checkpoint found too late, with ``window_start``
    and ``seconds_late``, the time by which the watermark had passed the end of their window.

    ``rows`` are the files or the table that the stream has read, as a batch. The log of the stream's
    source says which batch took a file. A batch goes by the watermark that the batch before it
    closed windows with, so by the rows of the batches before that.
    """
    spark = rows.sparkSession
    taken = taken_files(spark, checkpoint).toDF("_path", "_batch")
    own = rows.withColumn("_file", one_spelling(F.col("_metadata.file_path")))
    batches = own.join(taken, F.col("_file") == F.col("_path")).drop("_file", "_path")
    newest = batches.groupBy("_batch").agg(F.max(time).alias("_newest"))
    # One row for each batch.
    earlier = Window.orderBy("_batch").rangeBetween(Window.unboundedPreceding, -2)
    delay = F.expr(f"INTERVAL {late_by}")
    watermark = F.date_trunc("millisecond", F.max("_newest").over(earlier)) - delay
    watermarks = newest.select(F.col("_batch").alias("_of"), watermark.alias("_watermark"))
    window = F.window(time, width)
    seconds = (F.unix_micros("_watermark") - F.unix_micros("_end")) / 1_000_000
    return (
        batches.join(watermarks, F.col("_batch") == F.col("_of"))
        .withColumns({"window_start": window["start"], "_end": window["end"]})
        .where("_end <= _watermark")
        .select(*rows.columns, "window_start", seconds.alias("seconds_late"))
    )
