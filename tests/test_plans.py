"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as registry
from curbline.operators.days import one_day
from curbline.operators.refine import refine
from curbline.operators.totals import HOUR, ZONE, total_up
from curbline.plans import gold, reports
from curbline.schema import PICKUP, TRIP_SCHEMA
from curbline.sources import samples

SF_DIR = "/root/testdata/sf0.001"


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def formatted(rows) -> str:
    mode = rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return rows._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def trip_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trips") / "month")
    samples.trips(spark, SF_DIR).write.parquet(path)
    return spark.read.schema(TRIP_SCHEMA).parquet(path)


def read_schema(text: str) -> set[str]:
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", text).group(1)))


def test_gate_reaches_the_scan(trip_files):
    text = formatted(refine(trip_files))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for wanted in (
        "IsNotNull(tpep_pickup_datetime)",
        "IsNotNull(tpep_dropoff_datetime)",
        "LessThan(total_amount,1000.0)",
    ):
        assert wanted in pushed


def test_day_reaches_the_scan(trip_files):
    text = formatted(one_day(trip_files, PICKUP, registry.DAY))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed
    assert "LessThan(tpep_pickup_datetime" in pushed


def test_refinement_does_not_shuffle(trip_files):
    text = plan_of(refine(trip_files))
    assert "Exchange" not in text
    assert "*(1)" in text


def test_totals_read_only_their_columns_and_combine_before_the_shuffle(trip_files):
    rows = total_up(refine(trip_files), [ZONE])
    text = formatted(rows)
    assert read_schema(text) == {
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
        "PULocationID", "payment_type", "fare_amount", "tip_amount", "total_amount",
    }
    plan = plan_of(rows)
    assert plan.count("Exchange") == 1
    assert plan.index("partial_count") > plan.index("Exchange")  # below it in the tree


def test_unused_totals_are_pruned(trip_files):
    rows = reports.time_of_day_kpis(total_up(refine(trip_files), ["time_of_day"]))
    assert "passenger_count" not in read_schema(formatted(rows))


def test_hourly_window_comes_after_the_aggregation(trip_files):
    text = plan_of(gold.hourly_kpis(total_up(refine(trip_files), HOUR)))
    assert text.count("SinglePartition") == 1
    assert text.index("Window") < text.index("SinglePartition") < text.index("HashAggregate")
    assert text.index("Exchange SinglePartition") < text.index("Exchange hashpartitioning")


def test_counting_bronze_reads_no_column(trip_files):
    text = formatted(reports.quality_report(trip_files, refine(trip_files)))
    assert "ReadSchema: struct<>" in text


def test_top_zones_needs_no_full_sort(spark):
    rows = spark.createDataFrame(
        [], "location_id long, revenue_rank_overall int, zone_name string, borough string,"
        " total_trips long, total_revenue_usd double, avg_fare_usd double, avg_tip_pct double"
    )
    assert "TakeOrderedAndProject" in plan_of(gold.top_zones(rows))


LAZY = [
    "trips_day_window", "events_day_window", "quality_gate", "trip_measures", "trip_labels",
    "trip_flags", "silver_rows", "anomaly_breakdown", "time_of_day_kpis", "hourly_kpis",
    "quality_report", "conform_events",
]


@pytest.mark.parametrize("name", LAZY)
def test_queries_stay_in_the_jvm_without_cross_joins(spark, name):
    text = plan_of(registry.queries()[name](spark, SF_DIR))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHash"):
        assert unwanted not in text


def test_zone_kpis_keep_zones_apart_until_ranked(spark):
    text = plan_of(registry.zone_kpis(spark, SF_DIR))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text
    # The one single-partition exchange carries slice totals, not zones.
    assert text.count("SinglePartition") == 1
    assert re.search(r"Exchange SinglePartition.*\n.*HashAggregate\(keys=\[_slice", text)
