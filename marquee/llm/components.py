"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from marquee.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them (edges have u > v)."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(u, v)``; component: the smallest node reachable.

    Only joins and minimum aggregates over edges: no adjacency list is ever
    gathered, a node with very many edges is a skewed join key that adaptive
    execution splits.  Each round is written to the shared folder; rounds
    grow with the logarithm of the longest chain.  Loops, repeated edges,
    both directions and NULL ends are allowed (NULL ends are ignored); an
    empty input gives an empty result.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    seen = None
    for _ in range(max_rounds):
        watch = Observation()
        e = written(e.observe(watch, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")), "cc-round")
        state = (watch.get["n"], watch.get["sum"])
        if state[0] == 0 or state == seen:
            break
        seen = state
        e = _small_star(_large_star(e).distinct()).distinct()
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select("v", "v").distinct())
