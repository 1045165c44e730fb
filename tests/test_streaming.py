from __future__ import annotations

import os
import time
import uuid
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from curbline.operators.refine import refine
from curbline.operators.totals import HOUR, total_up
from curbline.plans import bronze, gold
from curbline.plans.lake import Lake
from curbline.schema import PICKUP, TRIP_COLUMNS, TRIP_SCHEMA, conform
from curbline.sources.files import file_stream
from curbline.sources.samples import trips as sample_trips
from curbline.streaming.archive import passed_over, taken_files
from curbline.streaming.ingest import with_ingest_columns
from curbline.streaming.tables import checkpoint_of, drain_to_table, table_folder
from curbline.streaming.windows import (
    close_windows,
    late_rows,
    open_windows,
    trip_windows,
    windowed,
    with_closing,
)
from tests.rows import START, frame, trip

MIDNIGHT = START.replace(hour=0)
ARRIVAL = [5, 3, 0, 1, 2, 4]
STAMPS = ["_ingest_timestamp", "_silver_timestamp", "_source_file", "_kafka_offset_sim", "_batch_hour"]


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "landing"))
    lake.create(str(tmp_path / "db"))
    return lake


def land(lake, hour, *trips, folder=None):
    made = frame(lake.spark, list(trips)).coalesce(1)
    made.write.mode("append").parquet(f"{lake.landing}/{folder or f'hour_{hour:02d}'}")


def land_hours(lake):
    """One trip per hour, the hours in no order."""
    for hour in ARRIVAL:
        pickup = MIDNIGHT + timedelta(hours=hour, minutes=5)
        land(lake, hour, trip(seconds=600, VendorID=hour, **{PICKUP: pickup}))


def micro_batches(spark, table):
    commits = Path(table_folder(spark, table).removeprefix("file:")) / "_checkpoint" / "commits"
    return sum(entry.name.isdigit() for entry in commits.iterdir())


def test_bronze_columns(spark, lake):
    land_hours(lake)
    stream = with_ingest_columns(file_stream(spark, lake.landing))
    assert stream.isStreaming
    lake.fill_bronze()
    table = spark.table(lake.bronze)
    assert table.columns == [
        *TRIP_COLUMNS, "_ingest_timestamp", "_source_file", "_kafka_offset_sim", "_batch_hour",
    ]
    assert dict(table.dtypes)["_batch_hour"] == "int"
    assert dict(table.dtypes)["_kafka_offset_sim"] == "bigint"
    assert table.filter("_batch_hour != VendorID").isEmpty()
    assert table.select("_source_file", "_kafka_offset_sim").distinct().count() == 6
    assert [tuple(row) for row in bronze.batch_hour_counts(table).collect()] == [
        (hour, 1) for hour in range(6)
    ]
    assert bronze.sample(table, 3).count() == 3


def test_file_outside_an_hour_folder_has_no_hour(spark, lake):
    land(lake, 0, trip(), folder="elsewhere")
    lake.fill_bronze()
    assert spark.table(lake.bronze).first()._batch_hour is None


def test_offsets_count_rows_within_a_file(spark, lake):
    land(lake, 7, *(trip() for _ in range(50)))
    land(lake, 8, *(trip() for _ in range(30)))
    lake.fill_bronze()
    offsets = spark.table(lake.bronze).groupBy("_batch_hour").agg(
        F.min("_kafka_offset_sim"), F.max("_kafka_offset_sim"), F.count_distinct("_kafka_offset_sim")
    )
    assert sorted(map(tuple, offsets.collect())) == [(7, 0, 49, 50), (8, 0, 29, 30)]


@pytest.mark.parametrize("max_files", [1, None])
def test_stream_equals_batch(spark, lake, max_files):
    rows = sample_trips(spark, "/root/testdata/sf0.001")
    for hour in (4, 0, 3, 1, 2):  # out of order, and with many late rows
        part = rows.filter((F.hour(PICKUP) % 5) == hour).coalesce(1)
        part.write.parquet(f"{lake.landing}/hour_{hour:02d}")
    limits = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    lake = Lake(spark, lake.database, lake.landing, source_options=limits)
    lake.fill_bronze()
    lake.fill_silver()
    for table in (lake.bronze, lake.silver):
        assert micro_batches(spark, table) == (5 if max_files else 1)
    streamed = spark.table(lake.silver)
    assert streamed.columns[-1] == "_silver_timestamp"
    streamed = streamed.drop(*STAMPS)
    batch = refine(rows).drop(*STAMPS)
    assert streamed.columns == batch.columns
    assert streamed.exceptAll(batch).isEmpty()
    assert batch.exceptAll(streamed).isEmpty()


def test_each_file_is_taken_once(spark, lake):
    land_hours(lake)
    for expected in (6, 6):
        lake.fill_bronze()
        lake.fill_silver()
        assert spark.table(lake.bronze).count() == spark.table(lake.silver).count() == expected
    land(lake, 9, trip(), trip(seconds=-5))
    lake.fill_bronze()
    lake.fill_silver()
    assert spark.table(lake.bronze).count() == 8
    assert spark.table(lake.silver).count() == 7


def test_reset_drops_checkpoints_and_later_tables(spark, lake):
    land_hours(lake)
    lake.fill_bronze()
    lake.fill_silver()
    lake.reset(lake.silver)
    assert spark.catalog.tableExists(lake.bronze)
    assert not spark.catalog.tableExists(lake.silver)
    lake.fill_silver()
    assert spark.table(lake.silver).count() == 6
    lake.reset()
    assert not spark.catalog.tableExists(lake.bronze)
    lake.fill_bronze()
    lake.fill_silver()
    assert spark.table(lake.bronze).count() == spark.table(lake.silver).count() == 6


def test_table_folder_matches_spark(spark, lake):
    land_hours(lake)
    lake.fill_bronze()
    (location,) = (
        row.data_type
        for row in spark.sql(f"DESCRIBE EXTENDED {lake.bronze}").collect()
        if row.col_name == "Location"
    )
    assert table_folder(spark, lake.bronze) == location


def test_files_of_other_types_are_cast_on_the_way_in(spark, lake):
    """Whole-number counts and times without a zone, as some months have them."""
    typed = {"passenger_count": "long", "RatecodeID": "long", PICKUP: "timestamp_ntz"}
    columns = TRIP_COLUMNS | typed
    conform(frame(spark, [trip(passenger_count=2.0)]), columns).write.parquet(
        f"{lake.landing}/hour_10"
    )
    bronze.ingest(spark, lake.landing, lake.bronze, file_columns=columns)
    table = spark.table(lake.bronze)
    assert table.select(*TRIP_COLUMNS).schema == TRIP_SCHEMA
    row = table.first()
    assert (row.passenger_count, row[PICKUP], row._batch_hour) == (2.0, START, 10)
    lake.fill_silver()
    assert spark.table(lake.silver).count() == 1


def test_failed_stream_raises(spark, lake):
    wrong = spark.range(3).selectExpr("CAST(id AS STRING) AS total_amount")
    wrong.write.parquet(f"{lake.landing}/hour_00")
    with pytest.raises(StreamingQueryException):
        lake.fill_bronze()


def test_watermark_drops_nothing_on_the_way_to_silver(spark, lake):
    land_hours(lake)
    lake = Lake(spark, lake.database, lake.landing, source_options={"maxFilesPerTrigger": "1"})
    lake.fill_bronze()
    lake.fill_silver()
    assert spark.table(lake.silver).count() == 6


def closed_windows(lake, max_files):
    limits = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    stream = file_stream(lake.spark, lake.landing, **limits)
    table = f"{lake.database}.windows"
    counted = {"trips": F.count(F.lit(1))}
    drain_to_table(windowed(stream, PICKUP, ["VendorID"], counted), table)
    return sorted(row.VendorID for row in lake.spark.table(table).collect())


def test_windows_close_behind_the_watermark(lake):
    """All in one batch: each window that ends ten minutes before 05:05 is closed."""
    land_hours(lake)
    assert closed_windows(lake, None) == [0, 1, 2, 3]


def test_rows_behind_the_watermark_are_dropped(lake):
    """One file per batch: 05:05 comes first and puts the other hours behind the watermark."""
    land_hours(lake)
    assert set(closed_windows(lake, 1)) < {0, 1, 2, 3}


def test_closing_emits_every_window(lake):
    land_hours(lake)
    stream, folder = file_stream(lake.spark, lake.landing), f"{lake.landing}_markers"
    counted = {"trips": F.count(F.lit(1))}
    windows = windowed(with_closing(stream, folder), PICKUP, ["VendorID"], counted)
    table = f"{lake.database}.windows"
    drain_to_table(windows, table)
    open_ = lake.spark.table(table).count()
    close_windows(stream, folder, PICKUP, START + timedelta(days=2))
    drain_to_table(windows, table)
    closed = lake.spark.table(table)
    assert open_ < closed.count() and closed.agg(F.sum("trips")).first()[0] == 6
    # A second marker closes the window of the first one, which has no rows.
    close_windows(stream, folder, PICKUP, START + timedelta(days=4))
    drain_to_table(windows, table)
    assert lake.spark.table(table).agg(F.sum("trips")).first()[0] == 6


def counted_windows(lake, max_files=None):
    """VendorID and trips of closed, open and late windows after a drain."""
    limits = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    stream, table = file_stream(lake.spark, lake.landing, **limits), f"{lake.database}.windows"
    drain_to_table(windowed(stream, PICKUP, ["VendorID"], {"trips": F.count(F.lit(1))}), table)
    checkpoint = checkpoint_of(lake.spark, table)
    opened = open_windows(lake.spark, checkpoint, ["VendorID"], ["trips"])
    files = lake.spark.read.schema(TRIP_SCHEMA).option("recursiveFileLookup", True).parquet(lake.landing)
    late = late_rows(files, checkpoint, PICKUP)
    found = [sorted((r.VendorID, r.trips) for r in rows.collect()) for rows in (lake.spark.table(table), opened)]
    return *found, sorted((r.VendorID, r.seconds_late) for r in late.collect())


def test_open_windows_come_from_the_state(spark, lake):
    land_hours(lake)
    closed, opened, late = counted_windows(lake)
    assert closed == [(h, 1) for h in range(4)] and opened == [(4, 1), (5, 1)] and late == []
    # A row in time for an open window still counts, and nothing comes out twice.
    pickup = MIDNIGHT + timedelta(hours=5, minutes=50)
    land(lake, 6, trip(seconds=60, VendorID=5, **{PICKUP: pickup}))
    closed, opened, late = counted_windows(lake)
    assert closed == [(h, 1) for h in range(5)] and opened == [(5, 2)] and late == []


@pytest.mark.parametrize("max_files", [1, 2])
def test_emitted_open_and_late_rows_are_all_rows(spark, lake, max_files):
    for hour in ARRIVAL:
        trips = [trip(VendorID=hour, **{PICKUP: MIDNIGHT + timedelta(hours=hour, minutes=m)}) for m in (1, 40)]
        land(lake, hour, *trips)
        time.sleep(1.1)  # the order of files is that of their times
    closed, opened, late = counted_windows(lake, max_files)
    assert len(late) > 0 and sum(n for _, n in closed + opened) + len(late) == 12
    assert {v for v, _ in late}.isdisjoint(v for v, _ in opened)
    # A second drain, and rows that are late for it.
    land(lake, 7, trip(VendorID=9, **{PICKUP: MIDNIGHT + timedelta(hours=9)}))
    time.sleep(1.1)
    land(lake, 8, trip(VendorID=1, **{PICKUP: MIDNIGHT + timedelta(hours=1)}))
    closed, opened, late = counted_windows(lake, max_files)
    assert sum(n for _, n in closed + opened) + len(late) == 14
    land(lake, 9, trip(VendorID=2, **{PICKUP: MIDNIGHT + timedelta(hours=2)}))
    closed, opened, late = counted_windows(lake, max_files)
    assert sum(n for _, n in closed + opened) + len(late) == 15
    assert (2, 21000.0 if max_files == 1 else 9000.0) in late


def test_means_cannot_be_read_from_the_state(spark, lake):
    land_hours(lake)
    table = f"{lake.database}.windows"
    drain_to_table(windowed(file_stream(spark, lake.landing), PICKUP, [], {"mean": F.avg("fare_amount")}), table)
    with pytest.raises(ValueError, match="kept in 2 values"):
        open_windows(spark, checkpoint_of(spark, table), [], ["mean"])


def test_lake_windows_are_the_hourly_kpis(spark, lake):
    sample_trips(spark, "/root/testdata/sf0.001").write.parquet(f"{lake.landing}/hour_00")
    lake.fill_bronze()
    lake.fill_silver()
    lake.fill_windows()
    found = lake.windows().withColumn("pickup_hour", F.hour("window_start"))
    assert found.filter("is_open").count() == 1 and lake.late_trips().isEmpty()
    hourly = gold.hourly_kpis(total_up(spark.table(lake.silver), HOUR)).select(
        [c for c in found.columns if c not in ("is_open", "window_start")]
    )
    assert found.count() == 24
    assert found.select(hourly.columns).exceptAll(hourly).isEmpty()


def test_files_are_taken_however_old_they_are(spark, lake):
    land_hours(lake)
    lake.fill_bronze()
    before = spark.table(lake.bronze).count()
    frame(spark, [trip(), trip()]).write.parquet(f"{lake.landing}/late/hour_01")
    weeks_ago = time.time() - 60 * 86400
    for path in Path(f"{lake.landing}/late").rglob("*"):
        os.utime(path, (weeks_ago, weeks_ago))
    lake.fill_bronze()
    assert spark.table(lake.bronze).count() == before + 2


def test_taken_files_move_to_the_archive(spark, lake, tmp_path):
    land_hours(lake)
    archiving = Lake(spark, lake.database, lake.landing, archive=str(tmp_path / "archive"))
    for hour in (7, 8, 9):
        archiving.fill_bronze()
        land(lake, hour, trip(VendorID=hour))
    archiving.fill_bronze()
    left, moved = (list(Path(p).rglob("*.parquet")) for p in (lake.landing, tmp_path / "archive"))
    assert len(moved) >= 6 and len(left) + len(moved) == 9
    assert spark.table(lake.bronze).count() == 9
    assert taken_files(spark, checkpoint_of(spark, lake.bronze)).count() == 9


def test_files_that_a_forgetful_stream_passes_over_are_caught_up(spark, lake, tmp_path):
    """A late copy that kept its old time. Without the comparison it would be lost without an error."""
    land_hours(lake)
    archive = str(tmp_path / "archive")
    archiving = Lake(spark, lake.database, lake.landing, archive=archive)
    archiving.fill_bronze()
    frame(spark, [trip(), trip()]).coalesce(1).write.parquet(f"{lake.landing}/late/hour_01")
    old = time.time() - 90 * 86400
    for path in Path(f"{lake.landing}/late").rglob("*"):
        os.utime(path, (old, old))
    checkpoint = checkpoint_of(spark, lake.bronze)
    bronze.ingest(spark, lake.landing, lake.bronze, source_options={"maxFileAge": "30d"})
    assert spark.table(lake.bronze).count() == 6
    assert passed_over(spark, lake.landing, checkpoint).count() == 1
    archiving.fill_bronze()
    assert spark.table(lake.bronze).count() == 8
    assert passed_over(spark, lake.landing, checkpoint).isEmpty()


def test_trip_windows_equal_hourly_kpis_of_closed_hours(spark, lake):
    rows = sample_trips(spark, "/root/testdata/sf0.001")
    rows.write.parquet(f"{lake.landing}/hour_00")
    lake.fill_bronze()
    lake.fill_silver()
    table = f"{lake.database}.windows"
    drain_to_table(trip_windows(spark.readStream.table(lake.silver)), table)
    streamed = spark.table(table).withColumn("pickup_hour", F.hour("window_start"))
    streamed = streamed.drop("window_start")
    hourly = gold.hourly_kpis(total_up(spark.table(lake.silver), HOUR))
    closed = hourly.filter("pickup_hour < 23").select(streamed.columns)
    assert streamed.count() == 23
    assert streamed.exceptAll(closed).isEmpty()


def test_drain_gives_up_after_the_timeout(spark, lake):
    land_hours(lake)
    stream = with_ingest_columns(file_stream(spark, lake.landing, maxFilesPerTrigger="1"))
    with pytest.raises(TimeoutError):
        drain_to_table(stream, lake.bronze, timeout_seconds=0.001)
    # Nothing is lost: the next drain takes up where this one stopped.
    lake.fill_bronze()
    assert spark.table(lake.bronze).count() == 6


def test_schema_is_declared_not_inferred(spark, lake):
    land_hours(lake)
    assert file_stream(spark, lake.landing).schema == TRIP_SCHEMA
