from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curbline.operators.refine import refine
from curbline.operators.totals import HOUR, ZONE, roll_up, total_up
from curbline.operators.zones import add_zone_names, require_unique_zones
from curbline.plans import gold, reports
from curbline.schema import PICKUP
from curbline.plans.reports import quality_report, totals_report
from tests.rows import START, frame, trip

ZONES = "location_id long, borough string, zone_name string, service_zone string"


@pytest.fixture(scope="module")
def silver(spark):
    trips = [
        trip(),
        trip(payment_type=2, total_amount=75.0, **{PICKUP: START.replace(hour=3)}, seconds=600),
        trip(PULocationID=7, fare_amount=0.0),  # anomalous
        trip(PULocationID=7, tip_amount=None, total_amount=40.0),  # unknown whether anomalous
        trip(PULocationID=9, trip_distance=0.0, total_amount=60.0),  # unknown: no speed
        trip(PULocationID=None, total_amount=500.0),
    ]
    return refine(frame(spark, trips))


@pytest.fixture(scope="module")
def zones(spark):
    rows = [(132, "Queens", "Airport", "Airports"), (7, "Queens", "Astoria", "Boro Zone")]
    return spark.createDataFrame(rows, ZONES)


def test_zone_kpis(silver, zones):
    table = gold.zone_kpis(total_up(silver, [ZONE]), zones)
    assert table.columns == [
        "location_id", *gold.ZONE_KPIS, "borough", "zone_name", "service_zone",
        "revenue_rank_overall", "_gold_updated_at",
    ]
    rows = {row.location_id: row for row in table.collect()}
    assert rows.keys() == {132, 7, 9}
    assert rows[132].total_revenue_usd == 100.0
    assert rows[132].credit_card_pct == 50.0
    assert rows[132].anomaly_count == 0
    assert (rows[132].revenue_rank_overall, rows[132].zone_name) == (1, "Airport")
    # Flagged and undecided trips count as trips but not as revenue.
    assert (rows[7].total_trips, rows[7].total_revenue_usd, rows[7].anomaly_count) == (2, 0.0, 1)
    # Only undecided trips: no anomaly count at all, and no mean speed.
    assert (rows[9].anomaly_count, rows[9].avg_speed_mph, rows[9].borough) == (None, None, None)
    assert rows[7].revenue_rank_overall == rows[9].revenue_rank_overall == 2


def test_hourly_kpis(silver):
    table = gold.hourly_kpis(total_up(silver, HOUR))
    assert table.columns == [
        "pickup_hour", "time_of_day", *gold.HOURLY_KPIS, "revenue_rank", "peak_hour",
        "_gold_updated_at",
    ]
    rows = [row.asDict() for row in table.collect()]
    assert [(row["pickup_hour"], row["time_of_day"]) for row in rows] == [(3, "night"), (10, "morning")]
    assert [row["total_trips"] for row in rows] == [1, 5]
    assert [row["total_revenue_usd"] for row in rows] == [75.0, 525.0]
    assert [row["revenue_rank"] for row in rows] == [2, 1]
    assert [row["cash_trips"] for row in rows] == [1, 0]
    assert [row["credit_card_trips"] for row in rows] == [0, 5]


def test_tied_hours_can_all_be_peak(spark):
    trips = [trip(**{PICKUP: START.replace(hour=hour)}, seconds=600) for hour in range(5)]
    table = gold.hourly_kpis(total_up(refine(frame(spark, trips)), HOUR))
    assert [(row.revenue_rank, row.peak_hour) for row in table.collect()] == [(1, True)] * 5


def test_fine_totals_add_up_to_coarse_ones(silver):
    fine = total_up(silver, [ZONE, *HOUR])
    for keys in ([ZONE], HOUR, ["time_of_day"], []):
        rolled, direct = roll_up(fine, keys), total_up(silver, keys)
        assert rolled.columns == direct.columns
        assert sorted(map(str, rolled.collect())) == sorted(map(str, direct.collect()))


def test_reports_on_small_data(silver, zones, spark):
    totals = total_up(silver, [])
    assert reports.anomaly_breakdown(totals).first().asDict() == {
        "zero_fare": 1, "impossible_speed": 0, "long_trip_5h": 0, "negative_amount": 0,
        "no_passengers": 0, "total_anomalies": 1,
    }
    by_part = reports.time_of_day_kpis(total_up(silver, ["time_of_day"]))
    assert [tuple(row) for row in by_part.collect()] == [
        ("morning", 5, 16.0, 11.3), ("night", 1, 20.0, 15.0),
    ]
    report = reports.run_report(
        silver,
        silver,
        gold.zone_kpis(total_up(silver, [ZONE]), zones),
        gold.hourly_kpis(total_up(silver, HOUR)),
    ).first()
    assert report.asDict() == {
        "bronze_rows": 6, "silver_rows": 6, "dropped_rows": 0, "anomalies": 1,
        "anomaly_rate_pct": 16.7, "zone_rows": 3, "hourly_rows": 2, "total_revenue_usd": 100.0,
        "peak_hour": 10, "peak_hour_revenue_usd": 525.0, "top_location_id": 132,
        "top_zone_name": "Airport", "top_borough": "Queens",
    }


def test_reports_on_no_data(spark):
    nothing = refine(frame(spark, []))
    row = reports.quality_report(nothing, nothing).first()
    assert (row.silver_rows, row.anomaly_rate_pct) == (0, None)
    assert reports.anomaly_breakdown(total_up(nothing, [])).first().total_anomalies is None


def test_invariants(silver, zones):
    counts = silver.agg(
        F.count_if("is_anomaly"), F.count_if(~F.col("is_anomaly")), F.count_if(F.col("is_anomaly").isNull())
    ).first()
    assert sum(counts) == silver.count()
    hourly = gold.hourly_kpis(total_up(silver, HOUR))
    assert hourly.agg(F.sum("total_trips")).first()[0] == silver.count()
    zone_table = gold.zone_kpis(total_up(silver, [ZONE]), zones)
    with_zone = silver.filter(F.col(ZONE).isNotNull()).count()
    assert zone_table.agg(F.sum("total_trips")).first()[0] == with_zone


def test_top_zones_breaks_ties_by_location(silver, zones):
    top = gold.top_zones(gold.zone_kpis(total_up(silver, [ZONE]), zones), rows=2).collect()
    assert [row.zone_name for row in top] == ["Airport", "Astoria"]


def test_repeated_zone_is_refused(spark, zones):
    assert require_unique_zones(zones) is zones
    doubled = zones.unionByName(zones.filter("location_id = 132"))
    with pytest.raises(ValueError, match="132"):
        require_unique_zones(doubled)


def test_zone_kpis_refuse_a_repeated_zone(silver, zones):
    doubled = zones.unionByName(zones.filter("location_id = 132"))
    with pytest.raises(ValueError, match="132"):
        gold.zone_kpis(total_up(silver, [ZONE]), doubled)


def test_report_from_totals_equals_the_report_from_trips(silver):
    totals = total_up(silver, [ZONE, *HOUR])
    assert totals_report(silver, totals).collect() == quality_report(silver, silver).collect()
    none = silver.limit(0)
    assert totals_report(none, total_up(none, [ZONE, *HOUR])).first().silver_rows == 0


def test_zone_join_broadcasts_only_below_the_threshold(spark, zones):
    rows = spark.range(10).select(F.col("id").alias("location_id"))

    def strategy():
        return add_zone_names(rows, zones)._jdf.queryExecution().sparkPlan().toString()

    small = zones.sparkSession.range(100, 103).select(
        F.col("id").alias("location_id"), F.lit("x").alias("zone_name")
    )
    known = add_zone_names(rows, small)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in known
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in strategy()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
