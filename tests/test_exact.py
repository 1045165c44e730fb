"""Sums that don't depend on the order of rows."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from curbline.operators.exact import LIMIT, exact_sum, exact_sums, exact_total


def summed(spark, values, partitions=1):
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
    return rows.agg(exact_sum(F.col("v"))).first()[0]


def bits(value):
    return struct.pack("<d", value)


@pytest.mark.parametrize("seed", range(4))
def test_sum_has_the_same_bits_in_any_order(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice((0.1, -0.3, 1e6, 1e-7, 37.25)) * rng.random() for _ in range(3000)]
    found = set()
    for partitions in (1, 3, 8):
        rng.shuffle(values)
        found.add(bits(summed(spark, values, partitions)))
    assert len(found) == 1
    exact = float(sum(Fraction(v) for v in values))
    assert struct.unpack("<d", found.pop())[0] == pytest.approx(exact, abs=3000 * 1e-9)


def test_partial_sums_add_up_to_the_same_bits(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.rand(3) * 1000 - 300).alias("v"))
    rows = spark.createDataFrame(rows.collect())
    fine = rows.groupBy("k").agg(*(c.alias(n) for n, c in exact_sums("v", F.col("v")).items()))
    rolled = fine.agg(*(F.sum(c).alias(c) for c in fine.columns[1:])).select(exact_total("v"))
    assert rolled.first()[0] == rows.agg(exact_sum(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "values, wanted",
    [
        ([0.1] * 10, 1.0),
        ([0.1, 0.2], 0.3),
        ([16.43, 16.44], 32.87),
        ([-0.5, 0.25, None], -0.25),
        ([None, None], None),
        ([], None),
        ([0.0], 0.0),
        ([1e300, 1.0], 1e300),
        ([LIMIT, -LIMIT, 1.5], 1.5),
        ([math.inf, 1.0], math.inf),
    ],
)
def test_sums(spark, values, wanted):
    assert summed(spark, values) == wanted


def test_a_sum_with_a_nan_is_one(spark):
    assert math.isnan(summed(spark, [1.0, math.nan, None]))


def test_sums_of_a_million_rows_stay_exact(spark):
    """A sum of doubles would be off."""
    rows = spark.range(0, 1_000_000, 1, 4).select(F.lit(0.1).alias("v"))
    assert rows.agg(exact_sum(F.col("v"))).first()[0] == 100_000.0
