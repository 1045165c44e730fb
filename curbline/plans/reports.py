"""Small result frames for checking a run. None of them prints or collects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.measures import percent_of
from curbline.functions.rules import quality_checks
from curbline.operators.exact import exact_sum
from curbline.operators.totals import roll_up, select_kpis

# Report column -> anomaly flag.
BREAKDOWN = {
    "zero_fare": "anomaly_zero_fare",
    "impossible_speed": "anomaly_speed",
    "long_trip_5h": "anomaly_long_trip",
    "negative_amount": "anomaly_negative_amount",
    "no_passengers": "anomaly_no_passengers",
    "total_anomalies": "is_anomaly",
}


def gate_report(trips: DataFrame) -> DataFrame:
    """One row: trips in, kept and dropped, and the trips failing each quality check."""
    checks = quality_checks()
    failing = {f"fails_{name}": ~F.coalesce(ok, F.lit(False)) for name, ok in checks.items()}
    flagged = trips.select(*(failed.alias(name) for name, failed in failing.items()))
    dropped = F.greatest(*(F.col(name) for name in failing))
    return flagged.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~dropped).alias("rows_kept"),
        F.count_if(dropped).alias("rows_dropped"),
        *(F.count_if(F.col(name)).alias(name) for name in failing),
    )


def quality_report(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: bronze and silver rows, rows dropped, anomalies and their rate.

    One pass over the flag column of silver; counting bronze reads no column.
    """
    counted = silver.agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(F.col("is_anomaly")).alias("anomalies"),
    )
    return _with_bronze(counted, bronze)


def _with_bronze(counted: DataFrame, bronze: DataFrame) -> DataFrame:
    return counted.withColumn("bronze_rows", bronze.agg(F.count(F.lit(1))).scalar()).select(
        "bronze_rows",
        "silver_rows",
        (F.col("bronze_rows") - F.col("silver_rows")).alias("dropped_rows"),
        "anomalies",
        percent_of(F.col("anomalies"), F.col("silver_rows")).alias("anomaly_rate_pct"),
    )


def totals_report(bronze: DataFrame, totals: DataFrame) -> DataFrame:
    """``quality_report`` from totals of silver, which hold its trips and anomalies already."""
    counted = roll_up(totals, []).select(
        F.coalesce("trips", F.lit(0)).alias("silver_rows"),
        F.coalesce("is_anomaly_trips", F.lit(0)).alias("anomalies"),
    )
    return _with_bronze(counted, bronze)


def anomaly_breakdown(totals: DataFrame) -> DataFrame:
    """One row: trips per anomaly flag. A trip with several flags counts in each."""
    return roll_up(totals, []).select(
        *(F.col(f"{flag}_trips").alias(name) for name, flag in BREAKDOWN.items())
    )


def time_of_day_kpis(totals: DataFrame) -> DataFrame:
    """Trips, mean fare and mean tip per part of the day, busiest first."""
    kpis = select_kpis(
        roll_up(totals, ["time_of_day"]),
        ["time_of_day"],
        ["total_trips", "avg_fare_usd", "avg_tip_pct"],
    )
    return kpis.withColumnsRenamed({"total_trips": "trip_count", "avg_fare_usd": "avg_fare"}).orderBy(
        F.desc("trip_count"), "time_of_day"
    )


def run_report(
    bronze: DataFrame,
    silver: DataFrame | None,
    zone_table: DataFrame,
    hourly_table: DataFrame,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row that sums up a run over its four tables, each read once.

    ``totals`` of silver, where they are at hand, stand in for it. ``silver_rows`` still holds the flagged trips. Total revenue is that of the zone
    table, so trips without a zone are not in it. Ties for the peak hour and the top
    zone go to the smaller hour and location id.
    """
    zones = zone_table.agg(
        F.count(F.lit(1)).alias("zone_rows"),
        F.round(exact_sum(F.col("total_revenue_usd")), 2).alias("total_revenue_usd"),
        F.min_by(
            F.struct("location_id", "zone_name", "borough"),
            F.struct("revenue_rank_overall", "location_id"),
        ).alias("top"),
    )
    hours = hourly_table.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.min_by(
                F.struct("pickup_hour", "total_revenue_usd"),
                F.struct("revenue_rank", "pickup_hour"),
            ).alias("peak"),
        )
    )
    if totals is not None:
        tallies = totals_report(bronze, totals)
    else:
        tallies = quality_report(bronze, silver)
    return (
        tallies.withColumns(
            {
                "_zones": zones.select(F.struct("*")).scalar(),
                "_hours": hours.scalar(),
            }
        )
        .select(
            *tallies.columns,
            F.col("_zones.zone_rows").alias("zone_rows"),
            F.col("_hours.rows").alias("hourly_rows"),
            F.col("_zones.total_revenue_usd").alias("total_revenue_usd"),
            F.col("_hours.peak.pickup_hour").alias("peak_hour"),
            F.col("_hours.peak.total_revenue_usd").alias("peak_hour_revenue_usd"),
            F.col("_zones.top.location_id").alias("top_location_id"),
            F.col("_zones.top.zone_name").alias("top_zone_name"),
            F.col("_zones.top.borough").alias("top_borough"),
        )
    )
