"""Numeric measures of a trip.

Measures build on one another's *rounded* values: speed is taken from the rounded
minutes, and the anomaly rules test the rounded speed and minutes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``; fractions of either are cut off."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def duration_minutes(start: Column, end: Column) -> Column:
    return F.round(seconds_between(start, end) / F.lit(60.0), 2)


def miles_per_hour(miles: Column, minutes: Column) -> Column:
    """NULL unless both are positive."""
    hours = minutes / F.lit(60.0)
    return F.when((miles > 0) & (minutes > 0), F.round(miles / hours, 2))


def tip_percent(tip: Column, fare: Column) -> Column:
    """Tip as a share of a positive fare; 0 where the fare is NULL or not positive."""
    return F.when(fare > 0, F.round(tip / fare * 100, 1)).otherwise(F.lit(0.0))


def per_mile(amount: Column, miles: Column) -> Column:
    """NULL unless the distance is positive."""
    return F.when(miles > 0, F.round(amount / miles, 2))


def percent_of(part: Column, whole: Column, digits: int = 1) -> Column:
    """NULL for an empty whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)
