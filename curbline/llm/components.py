"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import discard, stored

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every node of ``links`` (a, b).

    In each round, every node hands its larger neighbours, then its smaller ones, to the
    smallest node that it sees, which at least halves the longest path. Neighbours are never
    gathered: a round is a minimum by node, combined on the map side, and a join that
    adaptive execution splits where a node has very many of them. Rounds are stored, so
    lineage stays short.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.where("u <> v").distinct(), "edges")
    before = _mark(edges)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(
            F.inline(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            )
        )
        before_them, edges = edges, stored(small.where("u <> v").distinct(), "edges")
        discard(before_them)
        after = _mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not found in {MOST_ROUNDS} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(roots)


def _mark(edges: DataFrame):
    """Number of edges and an order-free sum over them: equal when the edges are."""
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mark).first())
