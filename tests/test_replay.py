from __future__ import annotations

import uuid
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from curbline import storage
from curbline.plans.replay import (
    day_folder,
    has_landed,
    hour_batch_counts,
    manifest,
    staging_folder,
    write_hour_batches,
)
from curbline.schema import PICKUP, TRIP_COLUMNS, conform
from curbline.sources.files import file_stream
from curbline.streaming.tables import drain_to_table
from tests.rows import START, frame, trip

DAY = date(2024, 1, 1)
MIDNIGHT = START.replace(hour=0)


def at(**since_midnight):
    return trip(**{PICKUP: MIDNIGHT + timedelta(**since_midnight)}, seconds=60)


def files(landing):
    return {
        folder.name: len(list(folder.glob("*.parquet")))
        for folder in Path(day_folder(landing, DAY)).iterdir()
        if folder.is_dir()
    }


def test_one_file_per_hour_of_the_day(spark, tmp_path):
    trips = [at(hours=h, minutes=m) for h in (0, 5, 23) for m in range(20)]
    trips += [at(microseconds=-1), at(hours=24), trip(**{PICKUP: None})]
    rows = frame(spark, trips).repartition(6)
    landing = str(tmp_path / "batches")
    write_hour_batches(rows, DAY, landing)
    assert files(landing) == {"hour=00": 1, "hour=05": 1, "hour=23": 1}
    written = spark.read.parquet(landing)
    assert written.columns == [*TRIP_COLUMNS, "day", "hour"]
    kept = frame(spark, trips[:60])
    assert conform(written).exceptAll(kept).isEmpty() and written.count() == 60

    counts = [tuple(row) for row in hour_batch_counts(spark, landing).collect()]
    assert counts == [(h, 20 if h in (0, 5, 23) else 0) for h in range(24)] + [(None, 60)]

    one = rows.limit(0).unionByName(frame(spark, [at(hours=1)]))
    with pytest.raises(ValueError, match="has landed"):
        write_hour_batches(one, DAY, landing)
    assert len(files(landing)) == 3
    write_hour_batches(one, DAY, landing, replace=True)
    assert files(landing) == {"hour=01": 1}


def test_landing_touches_one_day_only(spark, tmp_path):
    landing = tmp_path / "batches"
    rows = frame(spark, [at(hours=3), at(hours=27), at(hours=28)])
    write_hour_batches(rows, DAY, str(landing))
    (landing / "zones.csv").write_text("LocationID\n")
    write_hour_batches(rows, DAY + timedelta(days=1), str(landing))
    write_hour_batches(rows, DAY, str(landing), replace=True)
    assert (landing / "zones.csv").exists()
    assert spark.read.option("pathGlobFilter", "*.parquet").parquet(str(landing)).count() == 3


def test_counts_of_a_day_without_trips(spark, tmp_path):
    landing = str(tmp_path / "batches")
    write_hour_batches(frame(spark, [at(hours=30)]), DAY, landing)
    counts = hour_batch_counts(spark, day_folder(landing, DAY)).collect()
    assert [tuple(row) for row in counts] == [(h, 0) for h in range(24)] + [(None, 0)]


def test_counts_of_folders_spelled_otherwise(spark, tmp_path):
    frame(spark, [at(hours=7)] * 2).write.parquet(str(tmp_path / "b" / "hour_07"))
    counts = dict(map(tuple, hour_batch_counts(spark, str(tmp_path / "b")).collect()))
    assert counts[7] == counts[None] == 2


def test_hot_hour_is_split_over_tasks(spark, tmp_path):
    """An hour beyond the advisory size becomes several files, and no row is lost."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    rows = spark.range(0, 40_000, 1, 16).selectExpr(
        "id AS VendorID",
        "timestamp_seconds(1704067200 + IF(id % 3 = 0, id % 86400, 3600 * 8 + id % 3600))"
        f" AS {PICKUP}",
        "CAST(id * 0.37 AS DOUBLE) AS total_amount",
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        landing = str(tmp_path / "batches")
        write_hour_batches(conform(rows), DAY, landing)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert files(landing)["hour=08"] > 1
    counts = dict(map(tuple, hour_batch_counts(spark, landing).collect()))
    assert counts[None] == 40_000
    assert counts[8] > 26_000
    assert spark.read.parquet(landing).select("VendorID").distinct().count() == 40_000


def test_a_landing_that_broke_off_is_repeated(spark, tmp_path):
    """What older and failed landings leave: an unfinished folder, and staged files."""
    landing = str(tmp_path / "batches")
    left = Path(day_folder(landing, DAY)) / "_temporary" / "0"
    left.mkdir(parents=True)
    staged = Path(staging_folder(landing)) / f"day={DAY}.x" / "hour=01"
    staged.mkdir(parents=True)
    assert not has_landed(spark, landing, DAY)
    write_hour_batches(frame(spark, [at(hours=1), at(hours=1), at(hours=4)]), DAY, landing)
    assert has_landed(spark, landing, DAY) and files(landing) == {"hour=01": 1, "hour=04": 1}
    assert manifest(spark, landing, DAY) == {
        "day": "2024-01-01", "trips": 3, "hours": {"01": 2, "04": 1},
    }
    assert not any(Path(staging_folder(landing)).iterdir())
    assert spark.read.parquet(landing).count() == 3


def test_nothing_shows_of_a_landing_that_fails(spark, tmp_path):
    """A task fails after others have written their files; a stream sees none, then the whole day."""
    landing = str(tmp_path / "batches")
    rows = frame(spark, [at(hours=h) for h in range(8)]).repartition(8)
    broken = rows.withColumn(
        "total_amount", F.when(F.hour(PICKUP) == 7, F.raise_error(F.lit("no more disk")).cast("double"))
    )
    with pytest.raises(Exception, match="no more disk"):
        write_hour_batches(broken, DAY, landing)
    assert not Path(day_folder(landing, DAY)).exists()
    Path(landing).mkdir(exist_ok=True)
    table = f"t_{uuid.uuid4().hex}"
    drain_to_table(file_stream(spark, landing), table)
    write_hour_batches(rows, DAY, landing)
    drain_to_table(file_stream(spark, landing), table)
    assert spark.table(table).count() == 8
    spark.sql(f"DROP TABLE {table}")


def test_renames_never_overwrite(spark, tmp_path):
    for name in ("a", "b"):
        storage.write_text(spark, str(tmp_path / name), name)
    with pytest.raises(FileExistsError):
        storage.rename(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    with pytest.raises(Exception):
        storage.rename(spark, str(tmp_path / "none"), str(tmp_path / "c"))
    storage.rename(spark, str(tmp_path / "a"), str(tmp_path / "new" / "c"))
    assert storage.read_text(spark, str(tmp_path / "new" / "c")) == "a"
    assert storage.names_in(spark, str(tmp_path / "missing")) == []
