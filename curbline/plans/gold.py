"""Silver trips -> zone and hourly KPI tables.

Both tables take totals at their own grain or a finer one, so a run can scan the silver
table once (``trip_totals``) and build both from the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.operators.ranking import rank_descending
from curbline.operators.totals import HOUR, ZONE, roll_up, select_kpis, total_up
from curbline.operators.zones import add_zone_names, require_unique_zones
from curbline.session import keep
from curbline.streaming.segments import Segments
from curbline.streaming.versions import publish

REVENUE = "total_revenue_usd"
PEAK_HOURS = 3
TOP_ZONES = 15

# The columns of both gold tables and of the top zones.
ZONE_KPIS = [
    "total_trips",
    REVENUE,
    "avg_fare_usd",
    "avg_distance_miles",
    "avg_duration_mins",
    "avg_tip_pct",
    "avg_speed_mph",
    "anomaly_count",
    "credit_card_pct",
]
HOURLY_KPIS = [
    "total_trips",
    REVENUE,
    "avg_fare_usd",
    "avg_distance_miles",
    "avg_tip_pct",
    "avg_duration_mins",
    "credit_card_trips",
    "cash_trips",
    "anomaly_count",
    "avg_speed_mph",
]


def trip_totals(silver: DataFrame) -> DataFrame:
    """Stored totals per zone and hour: one scan that serves every KPI table and report."""
    return keep(total_up(silver, [ZONE, *HOUR]), "trip-totals")


def silver_totals(spark: SparkSession, folder: str) -> Segments:
    """Totals per zone and hour of all silver rows taken so far, in ``folder``.

    Totals add up, so old rows are never read again, and late rows for an old day are rows like
    others. Which rows are new is known from the files that each micro-batch took, so no row is
    lost or counted twice whatever the clocks of the loads say.
    """
    keys = [ZONE, *HOUR]
    return Segments(spark, folder, lambda rows: total_up(rows, keys), lambda t: roll_up(t, keys))


def zone_kpis(totals: DataFrame, zones: DataFrame) -> DataFrame:
    """KPIs per known pickup zone, with zone names and the rank by revenue.

    A lookup that repeats a location id is refused. The number of zones is set by the data, so the rank avoids a one-task window.
    """
    per_zone = roll_up(totals.filter(F.col(ZONE).isNotNull()), [ZONE])
    named = add_zone_names(
        select_kpis(per_zone, [F.col(ZONE).alias("location_id")], ZONE_KPIS),
        require_unique_zones(zones),
    )
    ranked = rank_descending(keep(named, "zone-kpis"), REVENUE, "revenue_rank_overall")
    return ranked.withColumn("_gold_updated_at", F.current_timestamp())


def hourly_kpis(totals: DataFrame) -> DataFrame:
    """KPIs per hour of the day, the rank by revenue and the peak hours.

    At most 24 rows reach the window. Tied hours share a rank, so more than three can
    be peak hours.
    """
    per_hour = roll_up(totals.filter(F.col("pickup_hour").isNotNull()), HOUR)
    by_revenue = Window.orderBy(F.desc(REVENUE))
    return (
        select_kpis(per_hour, HOUR, HOURLY_KPIS)
        .withColumn("revenue_rank", F.rank().over(by_revenue))
        .withColumn("peak_hour", F.col("revenue_rank") <= PEAK_HOURS)
        .withColumn("_gold_updated_at", F.current_timestamp())
        .orderBy("pickup_hour")
    )


def top_zones(zone_table: DataFrame, rows: int = TOP_ZONES) -> DataFrame:
    """The zones with the highest revenue; ties in order of location id."""
    return (
        zone_table.orderBy("revenue_rank_overall", "location_id")
        .limit(rows)
        .select(
            "revenue_rank_overall",
            "zone_name",
            "borough",
            "total_trips",
            REVENUE,
            "avg_fare_usd",
            "avg_tip_pct",
        )
    )


def replace_table(rows: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Replace ``table``, its schema included, without a moment in which readers find it missing or
    half written. Files get a new version; a table format with versions of its own is overwritten."""
    if table_format == "parquet":
        publish(rows, table)
        return
    writer = rows.write.format(table_format).mode("overwrite")
    if table_format == "delta":
        writer = writer.option("overwriteSchema", True)
    writer.saveAsTable(table)
