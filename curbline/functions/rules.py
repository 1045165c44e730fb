"""Row rules: what a trip must satisfy to be kept, and what marks it as anomalous."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline.functions.measures import seconds_between
from curbline.schema import DROPOFF, PICKUP

# Limits of the quality gate and of the anomaly rules.
TRIP_SECONDS_LIMIT = 24 * 60 * 60
TOTAL_AMOUNT_LIMIT = 1000
TOP_SPEED_MPH = 120
LONG_TRIP_MINUTES = 300


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.and_, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    """Three-valued OR: NULL when none is true and at least one is NULL."""
    return reduce(operator.or_, conditions)


def quality_checks() -> dict[str, Column]:
    """Checks a raw trip must pass. A check that comes out NULL counts as failed."""
    pickup, dropoff = F.col(PICKUP), F.col(DROPOFF)
    return {
        "pickup_known": pickup.isNotNull(),
        "dropoff_known": dropoff.isNotNull(),
        "ends_after_start": dropoff > pickup,
        "within_a_day": seconds_between(pickup, dropoff) < TRIP_SECONDS_LIMIT,
        "total_in_range": F.col("total_amount") < TOTAL_AMOUNT_LIMIT,
    }


def anomaly_rules() -> dict[str, Column]:
    """Flags over a trip that already has its measures. Flags may be NULL."""
    fare, miles = F.col("fare_amount"), F.col("trip_distance")
    passengers = F.col("passenger_count")
    charges = (fare, F.col("tip_amount"), F.col("total_amount"))
    return {
        "anomaly_zero_fare": (miles > 0) & (fare == 0),
        "anomaly_speed": F.col("speed_mph") > TOP_SPEED_MPH,
        "anomaly_long_trip": F.col("trip_duration_mins") > LONG_TRIP_MINUTES,
        "anomaly_negative_amount": any_of(charge < 0 for charge in charges),
        "anomaly_no_passengers": F.coalesce(passengers, F.lit(0.0)) == 0,
    }
