"""From raw trips to cleaned, measured and flagged trips.

One map-only stage: no step shuffles or keeps state, so the same functions run on a
batch and inside every micro-batch of a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions import labels, measures, rules
from curbline.schema import DROPOFF, PICKUP

LATE_BY = "10 minutes"

# The columns that silver adds.
DERIVED_COLUMNS = [
    "trip_duration_mins",
    "speed_mph",
    "tip_pct",
    "payment_type_desc",
    "pickup_hour",
    "pickup_date",
    "time_of_day",
    "fare_per_mile",
]
FLAG_COLUMNS = [
    "anomaly_zero_fare",
    "anomaly_speed",
    "anomaly_long_trip",
    "anomaly_negative_amount",
    "anomaly_no_passengers",
]


def quality_gate(trips: DataFrame) -> DataFrame:
    """Drop trips that fail any quality check."""
    return trips.filter(rules.all_of(rules.quality_checks().values()))


def add_measures(trips: DataFrame) -> DataFrame:
    """Add DERIVED_COLUMNS."""
    col = F.col
    wide = trips.withColumns(
        {
            "trip_duration_mins": measures.duration_minutes(col(PICKUP), col(DROPOFF)),
            "tip_pct": measures.tip_percent(col("tip_amount"), col("fare_amount")),
            "payment_type_desc": labels.payment_label(col("payment_type")),
            "pickup_hour": F.hour(PICKUP),
            "pickup_date": F.to_date(PICKUP),
            "fare_per_mile": measures.per_mile(col("fare_amount"), col("trip_distance")),
        }
    ).withColumns(
        {
            "speed_mph": measures.miles_per_hour(col("trip_distance"), col("trip_duration_mins")),
            "time_of_day": labels.day_part(col("pickup_hour")),
        }
    )
    return wide.select(*trips.columns, *DERIVED_COLUMNS)


def add_flags(trips: DataFrame) -> DataFrame:
    """Add FLAG_COLUMNS and ``is_anomaly``, their three-valued OR."""
    return trips.withColumns(rules.anomaly_rules()).withColumn(
        "is_anomaly", rules.any_of(F.col(name) for name in FLAG_COLUMNS)
    )


def refine(trips: DataFrame) -> DataFrame:
    """The refined trip: gate, measures, flags and the time of refinement.

    The gate comes before the watermark, since filters on the event time are not
    pushed to the scan through a watermark. On a batch the watermark has no effect;
    on a stream it travels with the pickup time to whatever keeps state later.
    """
    timed = quality_gate(trips).withWatermark(PICKUP, LATE_BY)
    return add_flags(add_measures(timed)).withColumn("_silver_timestamp", F.current_timestamp())
