"""Additive trip totals, and the KPIs computed from them.

Every KPI here is a sum, a count, or a ratio of the two. Totals at a fine grain can
therefore be added up to any coarser grain, and one pass over the refined trips
serves all KPI tables. The first aggregation combines on the map side, so a zone or
hour that holds a third of all trips reaches the shuffle as one row per task. Sums are exact,
so neither the partitions of a run nor the number of refreshes shows in a KPI.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions.measures import percent_of
from curbline.operators.exact import exact_sums, exact_total
from curbline.operators.refine import FLAG_COLUMNS

ZONE = "PULocationID"
HOUR = ["pickup_hour", "time_of_day"]

AVERAGED = ["fare_amount", "trip_distance", "trip_duration_mins", "tip_pct", "speed_mph"]
FLAGS = [*FLAG_COLUMNS, "is_anomaly"]


def _totals() -> dict[str, Column]:
    clean = F.when(~F.col("is_anomaly"), F.col("total_amount")).otherwise(F.lit(0.0))
    paid_by = F.col("payment_type_desc")
    totals = {
        "trips": F.count(F.lit(1)),
        **exact_sums("clean_revenue", clean),
        "credit_card_trips": F.count_if(paid_by == "credit_card"),
        "cash_trips": F.count_if(paid_by == "cash"),
    }
    for name in AVERAGED:
        totals |= exact_sums(name, F.col(name))
        totals[f"{name}_known"] = F.count(name)
    for name in FLAGS:
        totals[f"{name}_trips"] = F.sum(F.col(name).cast("int"))
    return totals


def total_names() -> list[str]:
    """The columns of totals, besides their keys."""
    return list(_totals())


def total_up(trips: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Additive totals of refined trips per ``keys``."""
    return trips.groupBy(*keys).agg(*(value.alias(name) for name, value in _totals().items()))


def roll_up(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add totals up to the coarser grain ``keys``."""
    return totals.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in _totals()))


def _mean(name: str, digits: int) -> Column:
    return F.round(F.try_divide(exact_total(name), F.col(f"{name}_known")), digits)


def kpis() -> dict[str, Column]:
    """Every KPI over a frame of totals, by output name."""
    return {
        "total_trips": F.col("trips"),
        "total_revenue_usd": F.round(exact_total("clean_revenue"), 2),
        "avg_fare_usd": _mean("fare_amount", 2),
        "avg_distance_miles": _mean("trip_distance", 2),
        "avg_duration_mins": _mean("trip_duration_mins", 1),
        "avg_tip_pct": _mean("tip_pct", 1),
        "avg_speed_mph": _mean("speed_mph", 1),
        "credit_card_trips": F.col("credit_card_trips"),
        "cash_trips": F.col("cash_trips"),
        "credit_card_pct": percent_of(F.col("credit_card_trips"), F.col("trips")),
        "anomaly_count": F.col("is_anomaly_trips"),
    }


def select_kpis(totals: DataFrame, keys: Sequence[Column | str], names: Sequence[str]) -> DataFrame:
    """``keys`` followed by the named KPIs."""
    known = kpis()
    return totals.select(*keys, *(known[name].alias(name) for name in names))
