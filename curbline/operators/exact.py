"""Sums of doubles that don't depend on the order of rows.

A double is taken as a whole number of units, and its units are cut into two parts that are added up
as longs. Long sums are exact, so partitions, partial sums and later refreshes can come in any order
and the result has the same bits. Adding doubles would not: a rounded cent could differ from
run to run. Values too large for units, and those that aren't finite, are added up beside them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A unit is this part of one; values under LIMIT fit into a long.
UNITS = 1_000_000_000
LIMIT = float(1 << 33)
# The low part of a value is under 2**LOW_BITS, so 2**43 rows can be added up.
LOW_BITS = 20


def parts_of(value: Column) -> tuple[Column, Column, Column]:
    """High part, low part, and the value itself where it has no units."""
    fits = F.abs(value) < LIMIT
    units = F.when(fits, F.rint(value * F.lit(float(UNITS))).cast("bigint"))
    high = F.shiftright(units, LOW_BITS)
    low = units.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint"))
    return high, low, F.when(~fits, value)


def exact_sums(name: str, value: Column) -> dict[str, Column]:
    """Additive aggregates that ``exact_total`` turns into the sum of ``value``."""
    high, low, odd = parts_of(value)
    return {f"{name}_high": F.sum(high), f"{name}_low": F.sum(low), f"{name}_odd": F.sum(odd)}


def _total(high: Column, low: Column, odd: Column) -> Column:
    wide = "decimal(38,0)"
    units = high.cast(wide) * F.lit(1 << LOW_BITS).cast("decimal(8,0)") + low.cast(wide)
    total = units.cast("double") / float(UNITS)
    return F.when(odd.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + odd)


def exact_total(name: str) -> Column:
    """The sum over the columns of ``exact_sums``; null where every value was null."""
    return _total(*(F.col(f"{name}_{part}") for part in ("high", "low", "odd")))


def exact_sum(value: Column) -> Column:
    """The sum of ``value`` as one aggregate."""
    return _total(*(F.sum(part) for part in parts_of(value)))
