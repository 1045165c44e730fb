"""The whole run, from trip files to the report, through the command line."""

from __future__ import annotations

import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from curbline.__main__ import main, parse
from curbline.operators.refine import refine
from curbline.operators.totals import HOUR, total_up
from curbline.operators.zones import zone_dimension
from curbline.plans import gold
from curbline.plans import silver as silver_plan
from curbline.plans.lake import Lake
from curbline.session import apply_settings, fresh_path, shared_folder
from curbline.sources import samples
from curbline.sources.files import table_stream
from curbline.streaming.segments import Segment, widest
from curbline.streaming.tables import drain_to_table

SF_DIR = "/root/testdata/sf0.001"


def test_run_from_the_command_line(spark, tmp_path, capsys):
    trips, zones = str(tmp_path / "month"), str(tmp_path / "zones")
    samples.trips(spark, SF_DIR).write.parquet(trips)
    samples.zone_lookup(spark, SF_DIR).coalesce(1).write.option("header", True).csv(zones)
    database, current = f"t_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    options = [
        "--database", database, "--database-location", str(tmp_path / "db"),
        "--landing", str(tmp_path / "landing"), "--trips", trips, "--zones", f"{zones}.csv",
        "--max-files-per-trigger", "7",
    ]
    try:
        main(options)
        lake = Lake(spark, database, str(tmp_path / "landing"))
        report = lake.report().first()
        # Landing the day again is refused, and nothing is doubled.
        with pytest.raises(ValueError, match="has landed"):
            main(options)
        assert lake.report().first() == report
        # With a reset, the whole run starts anew.
        main(["--reset", *options])
        assert lake.report().first() == report
        # A second run of the later stages replaces and adds nothing.
        main(["bronze", "silver", "gold", *options])
        assert lake.report().first() == report
        # A reset fills the tables anew.
        main(["bronze", "silver", "gold", "--reset", *options])
        assert lake.report().first() == report
    finally:
        spark.catalog.setCurrentDatabase(current)
    assert "top_zone_name" in capsys.readouterr().out
    assert report.bronze_rows == 6000
    assert report.hourly_rows == 24
    assert len(spark.table(lake.bronze).columns) == 23
    assert len(spark.table(lake.silver).columns) == 38
    assert len(spark.table(lake.gold_zones).columns) == 15
    assert len(spark.table(lake.gold_hours).columns) == 15
    assert silver_plan.sample(spark.table(lake.silver), 4).count() == 4


def filled_in_parts(spark, tmp_path, parts, stamp=None):
    """A lake whose trips come in ``parts`` loads, each followed by a refresh of gold."""
    lake = Lake(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "landing"))
    lake.create(str(tmp_path / "db"))
    trips = samples.trips(spark, SF_DIR, samples.EDGE_FIELDS)
    for part in range(parts):
        chosen = trips.filter(f"pmod(hash(VendorID, trip_distance, fare_amount), {parts}) = {part}")
        chosen.write.parquet(f"{lake.landing}/hour_{part:02d}")
        lake.fill_bronze()
        if stamp:
            rows = refine(table_stream(spark, lake.bronze)).withColumn("_silver_timestamp", stamp(part))
            drain_to_table(rows, lake.silver)
        else:
            lake.fill_silver()
        lake.fill_gold(zone_dimension(samples.zone_lookup(spark, SF_DIR)))
    return lake


def gold_rows(spark, lake):
    return [
        sorted((r.asDict() for r in spark.table(t).drop("_gold_updated_at").collect()), key=str)
        for t in (lake.gold_zones, lake.gold_hours)
    ]


def test_gold_refresh_adds_new_rows_only(spark, tmp_path):
    """Two loads, a late row for the first day among the second: as good as one computation."""
    lake = filled_in_parts(spark, tmp_path, 2)
    before = lake.gold_totals.complete()
    lake.fill_gold(zone_dimension(samples.zone_lookup(spark, SF_DIR)))  # nothing new
    assert lake.gold_totals.complete() == before == [Segment(0, 0), Segment(1, 1)]
    whole = gold.hourly_kpis(total_up(spark.table(lake.silver), HOUR)).drop("_gold_updated_at")
    stored = spark.table(lake.gold_hours).select(whole.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, whole.collect()))
    lake.reset(lake.silver)
    assert not lake.gold_totals.exists()


def test_gold_refresh_does_not_trust_clocks(spark, tmp_path):
    """Each load is stamped a day before the one that it follows."""
    lake = filled_in_parts(spark, tmp_path, 3, lambda part: F.lit(datetime(2030, 1, 9 - part)))
    assert spark.table(lake.silver).select("_silver_timestamp").distinct().count() == 3
    counted = lake.gold_totals.read().agg(F.sum("trips")).first()[0]
    assert counted == spark.table(lake.silver).count() > 4000


def test_repeated_batch_is_counted_once(spark, tmp_path):
    """The commit of the last batch is lost, as when a driver dies after writing totals."""
    lake = filled_in_parts(spark, tmp_path, 2)
    before = gold_rows(spark, lake)
    commits = Path(lake.gold_totals.checkpoint.removeprefix("file:")) / "commits"
    for file in (commits / "1", commits / ".1.crc"):
        file.unlink(missing_ok=True)
    lake.fill_gold(zone_dimension(samples.zone_lookup(spark, SF_DIR)))
    assert gold_rows(spark, lake) == before
    assert (commits / "1").exists()


def test_gold_is_the_same_however_many_loads(spark, tmp_path):
    """Bit for bit, with and without merged segments."""
    one, many = filled_in_parts(spark, tmp_path / "a", 1), filled_in_parts(spark, tmp_path / "b", 9)
    assert widest(many.gold_totals.complete()) == [Segment(0, 7), Segment(8, 8)]
    assert gold_rows(spark, one) == gold_rows(spark, many)


def test_readers_that_began_before_a_refresh_end_well(spark, tmp_path):
    lake = filled_in_parts(spark, tmp_path, 1)
    began = spark.table(lake.gold_zones)
    before = began.select("location_id").collect()
    files = began.inputFiles()
    lake.fill_gold(zone_dimension(samples.zone_lookup(spark, SF_DIR).limit(0)))
    assert sorted(began.select("location_id").collect()) == sorted(before)
    assert began.filter("zone_name IS NOT NULL").count() > 0
    assert spark.table(lake.gold_zones).filter("zone_name IS NOT NULL").isEmpty()
    assert set(spark.table(lake.gold_zones).inputFiles()).isdisjoint(files)


@pytest.mark.parametrize("arguments", [["land"], ["gold"], ["unheard-of"]])
def test_command_line_refuses_incomplete_arguments(arguments):
    with pytest.raises(SystemExit):
        parse([*arguments, "--landing", "x"])


def test_types_of_landing_files_can_be_named():
    options = parse(["bronze", "--landing", "x", "--file-type", "passenger_count=bigint"])
    assert options.file_type == ["passenger_count=bigint"]


def test_shared_folder_follows_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(f"{shared_folder(spark)}/curbline/x-")


class FakeConf(dict):
    set = dict.__setitem__


class FakeSession:
    def __init__(self, **conf):
        self.conf = FakeConf({key.replace("__", "."): value for key, value in conf.items()})


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession(spark__master="yarn"))
    named = FakeSession(spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/")
    assert shared_folder(named) == "hdfs:///shared"
    local = FakeSession(spark__master="local[2]", spark__app__id="app-1")
    assert shared_folder(local) == shared_folder(local)


def test_apply_settings():
    session = FakeSession()
    assert apply_settings(session) is session
    assert session.conf["spark.sql.session.timeZone"] == "UTC"
