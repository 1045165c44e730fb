"""Ranks over a whole frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 200


def rank_descending(rows: DataFrame, measure: str, out: str, slices: int = SLICES) -> DataFrame:
    """Add ``rank() over (order by measure desc nulls last)`` without a one-task window.

    A window without a partition key moves every row to one task. Here the distinct
    values are cut into ``slices`` ranges instead. A value's rank is one more than the
    rows in higher slices plus the rows with higher values in its own slice; only the
    slice totals, at most ``slices + 1`` rows, meet in one task. Equal values are counted
    before they are ranked, so a value shared by many rows is still one row to rank.

    ``rows`` is read several times and must give the same values each time: pass stored
    rows (see ``session.keep``).
    """
    value = F.col(measure)
    steps = [step / slices for step in range(1, slices)]
    cuts = sorted(set(rows.approxQuantile(measure, steps, 0.25 / slices)))

    tally = rows.groupBy(measure).agg(F.count(F.lit(1)).alias("_rows"))
    tally = tally.withColumn("_slice", _slice_of(value, cuts))

    totals = tally.groupBy("_slice").agg(F.sum("_rows").alias("_in_slice"))
    higher_slices = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_slice", _sum_over("_in_slice", higher_slices).alias("_above"))

    higher_values = (
        Window.partitionBy("_slice")
        .orderBy(value.desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        tally.withColumn("_before", _sum_over("_rows", higher_values))
        .join(offsets, "_slice")
        .select(
            value.alias("_ranked"), (F.col("_above") + F.col("_before") + 1).cast("int").alias(out)
        )
    )
    return rows.join(ranks, value.eqNullSafe(F.col("_ranked"))).drop("_ranked")


def _slice_of(value: Column, cuts: list[float]) -> Column:
    """0 for values at or above every cut, rising as values fall; NULL comes last."""
    if not cuts:
        return F.when(value.isNull(), F.lit(1)).otherwise(F.lit(0))
    above = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut > value))
    return F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(above)


def _sum_over(name: str, window) -> Column:
    return F.coalesce(F.sum(name).over(window), F.lit(0))
