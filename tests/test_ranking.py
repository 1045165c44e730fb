from __future__ import annotations

import random

import pytest

from curbline.operators.ranking import rank_descending
from curbline.session import keep


def brute_ranks(values):
    """1 + the number of strictly greater values; NULL is the least."""
    key = [float("-inf") if value is None else value for value in values]
    return {n: 1 + sum(other > mine for other in key) for n, mine in enumerate(key)}


def ranks(spark, values, **options):
    rows = spark.createDataFrame(list(enumerate(values)), "id long, revenue double")
    ranked = rank_descending(rows, "revenue", "place", **options)
    assert ranked.columns == ["id", "revenue", "place"]
    assert dict(ranked.dtypes)["place"] == "int"
    return {row.id: row.place for row in ranked.collect()}


@pytest.mark.parametrize("slices", [2, 7, 200])
def test_ranks_match_brute_force(spark, slices):
    random.seed(slices)
    values = [random.choice([None, 0.0, -3.5, round(random.gauss(0, 1e4), 2)]) for _ in range(600)]
    assert ranks(spark, values, slices=slices) == brute_ranks(values)


@pytest.mark.parametrize("values", [[], [None, None], [5.0], [2.0] * 9, [1.0, None, 1.0, 3.0]])
def test_small_and_tied_inputs(spark, values):
    assert ranks(spark, values) == brute_ranks(values)


# The default, and the plan for inputs too large to broadcast, with skewed values split.
PLANS = [
    {},
    {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    },
]


@pytest.mark.parametrize("plan", PLANS, ids=["broadcast", "merge"])
def test_matches_sql_rank_with_a_third_of_rows_tied(spark, plan):
    before = {key: spark.conf.get(key, None) for key in plan}
    for key, setting in plan.items():
        spark.conf.set(key, setting)
    try:
        check_a_third_tied(spark, "SortMergeJoin" if plan else "BroadcastHashJoin")
    finally:
        for key, setting in before.items():
            spark.conf.unset(key) if setting is None else spark.conf.set(key, setting)


def check_a_third_tied(spark, join):
    rows = spark.range(9000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 0.0 ELSE CAST(id * 7919 % 5003 AS DOUBLE) END AS revenue"
    )
    rows = keep(rows, "rank-test")
    rows.createOrReplaceTempView("rank_rows")
    expected = spark.sql(
        "SELECT id, revenue, rank() OVER (ORDER BY revenue DESC) AS place FROM rank_rows"
    )
    ranked = rank_descending(rows, "revenue", "place", slices=20)
    assert join in ranked._jdf.queryExecution().executedPlan().toString()
    assert ranked.exceptAll(expected).isEmpty()
    assert expected.exceptAll(ranked).isEmpty()


def test_only_slice_totals_meet_in_one_task(spark):
    rows = keep(spark.range(1000).selectExpr("id", "CAST(id AS DOUBLE) AS revenue"), "rank-plan")
    plan = rank_descending(rows, "revenue", "place")._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    ungrouped = [line for line in windows if "_in_slice" in line]
    assert len(ungrouped) == 1
