"""Selecting and labelling trips by time."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_day(rows: DataFrame, column: str, day: date) -> DataFrame:
    """Rows whose ``column`` lies in ``[day, day + 1)``. Both bounds reach the scan."""
    start, end = (
        F.lit(str(bound)).cast("timestamp") for bound in (day, day + timedelta(days=1))
    )
    return rows.filter((F.col(column) >= start) & (F.col(column) < end))


def two_digit_hour(column: str) -> Column:
    return F.date_format(column, "HH")
