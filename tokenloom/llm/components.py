"""Connected components by alternating large-star and small-star.

Large-star connects every larger neighbour of a node to the smallest node around it, small-star does so with the smaller
neighbours. Both keep components and end in stars around each component's smallest node, after a number of rounds that
grows with the logarithm of the diameter. A node with very many neighbours is no hot key: minima are summed before the
shuffle, and the join that hands them back is a plain one, whose large partitions the adaptive planner splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.plans.staging import staged

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    around = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return around.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component_id`` of every node that has an edge to another; ``component_id`` is the smallest id reachable.

    Edges may repeat and come in either direction; loops and edges with a null end are ignored.
    """
    big, small = F.greatest(a, b), F.least(a, b)
    now = staged(edges.where(F.col(a) != F.col(b)).select(big.alias("u"), small.alias("v")).distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state["n"] == 0 or mark == (state["n"], state["x"]):
            return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
            )
        mark = (state["n"], state["x"])
        now = staged(_small_star(_large_star(now)), "edges")
    raise RuntimeError("components did not settle")
