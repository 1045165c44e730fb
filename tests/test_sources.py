from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from curbline.functions.labels import hour_in_path
from curbline.operators.zones import zone_dimension
from curbline.schema import PICKUP, TRIP_COLUMNS, TRIP_SCHEMA, conform
from curbline.sources import samples
from curbline.sources.files import _layout, layouts, read_trips, read_zone_lookup, scans_by_layout
from tests.rows import frame, trip

CSV = 'LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, NJ",EWR\n264,Unknown,N/A,\n'
EXPECTED = [(1, "EWR", "Newark, NJ", "EWR"), (264, "Unknown", "N/A", None)]


def zones_at(spark, path):
    return zone_dimension(read_zone_lookup(spark, str(path)))


def test_zone_file(spark, tmp_path):
    (tmp_path / "zones.csv").write_text(CSV)
    zones = zones_at(spark, tmp_path / "zones.csv")
    assert [tuple(row) for row in zones.collect()] == EXPECTED
    assert zones.dtypes == [
        ("location_id", "bigint"), ("borough", "string"), ("zone_name", "string"),
        ("service_zone", "string"),
    ]


def test_zone_folder_stands_in_for_a_missing_file(spark, tmp_path):
    (tmp_path / "zones").mkdir()
    (tmp_path / "zones" / "part-0.csv").write_text(CSV)
    assert [tuple(row) for row in zones_at(spark, tmp_path / "zones.csv").collect()] == EXPECTED


def test_zone_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("Zone,note,LocationID,service_zone,Borough\nA,x,5,S,B\n")
    assert [tuple(row) for row in zones_at(spark, tmp_path / "zones.csv").collect()] == [(5, "B", "A", "S")]


def test_missing_zone_lookup_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_zone_lookup(spark, str(tmp_path / "none.csv"))


def test_broken_zone_lookup_is_not_hidden(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Borough\n1,A\n")
    (tmp_path / "zones").mkdir()
    (tmp_path / "zones" / "part-0.csv").write_text(CSV)
    with pytest.raises(AnalysisException):
        zones_at(spark, tmp_path / "zones.csv")


def test_conform_casts_renames_and_fills(spark, tmp_path):
    # A month file with integer counts, a time without zone and other letter case.
    spark.sql(
        "SELECT 2 AS vendorid, TIMESTAMP_NTZ '2024-01-01 05:06:07' AS tpep_pickup_datetime,"
        " CAST(3 AS BIGINT) AS passenger_count, 1.25D AS airport_fee, 'x' AS unknown_column"
    ).write.parquet(str(tmp_path / "month"))
    trips = read_trips(spark, str(tmp_path / "month"))
    assert trips.schema == TRIP_SCHEMA
    row = trips.withColumn("at", F.col(PICKUP).cast("string")).first()
    assert (row.VendorID, row.at, row.passenger_count) == (2, "2024-01-01 05:06:07", 3.0)
    assert (row.Airport_fee, row.total_amount) == (1.25, None)


def test_conform_leaves_conforming_rows_alone(spark):
    rows = frame(spark, [trip(), trip(passenger_count=None)])
    assert conform(rows).collect() == rows.collect()


def test_hour_in_path(spark):
    paths = ["/l/hour_07/p.parquet", "/l/hour=23/p.parquet", "/l/hour_/p", "/l/day=1/p"]
    rows = spark.createDataFrame([(path,) for path in paths], "path string")
    assert [row[0] for row in rows.select(hour_in_path(F.col("path"))).collect()] == [7, 23, None, None]


def test_sample_trips(spark):
    rows = samples.trips(spark, "/root/testdata/sf0.001")
    assert rows.columns == list(TRIP_COLUMNS)
    raw = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert rows.count() == raw.count()


@pytest.fixture
def mixed(spark, tmp_path):
    """Months of two layouts: two whole folders, one that mixes them, one with a folder below it."""
    whole = spark.createDataFrame([(1, 2), (3, 4)], "VendorID long, passenger_count long")
    other = whole.selectExpr("VendorID", "CAST(passenger_count AS STRING) AS passenger_count")
    for name, rows in (("a", whole), ("b", other), ("c", whole), ("c", other), ("d", whole), ("d/e", other)):
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    (tmp_path / "a" / "_notes.txt").write_text("not data")
    return str(tmp_path)


def test_folders_of_two_layouts_are_read(spark, mixed):
    scans = scans_by_layout(spark, mixed)
    assert len(scans) == 2
    rows = [row for scan in scans for row in conform(scan).select("VendorID", "passenger_count").collect()]
    assert sorted(map(tuple, rows)) == sorted([(1, 2.0), (3, 4.0)] * 6)


def test_tasks_read_the_layouts(spark, mixed):
    found = layouts(spark, mixed)
    assert found.count() == 6 and found.select("layout").distinct().count() == 2
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()


def test_files_that_tasks_cannot_reach_are_layouts_of_their_own():
    assert _layout("nosuchstore://host/part.parquet") == "nosuchstore://host/part.parquet"


def test_months_of_conflicting_types(spark, tmp_path):
    for name, kind in (("month=1", "bigint"), ("month=2", "string"), ("month=3", "double")):
        spark.sql(f"SELECT 7 AS VendorID, CAST(2 AS {kind}) AS passenger_count").write.parquet(str(tmp_path / name))
    rows = read_trips(spark, str(tmp_path)).select("VendorID", "passenger_count").collect()
    assert sorted(map(tuple, rows)) == [(7, 2.0)] * 3


def test_other_errors_are_not_hidden(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_trips(spark, str(tmp_path / "none"))
