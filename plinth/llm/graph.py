"""Connected components over an edge table, by alternating large-star and small-star steps.

Edges never reach the driver: each round is two aggregations and two joins over edges, its result is written to the
shared folder, and only a row count and a checksum come back. Minima are combined before each shuffle, so a node with
a third of all edges is no bottleneck there; the joins are plain equi joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``: the root is the smallest node that can be reached.

    Self loops are allowed; an empty edge table gives an empty result. ``most_rounds`` guards against a defect, not
    against size: the number of rounds grows with the logarithm of the longest chain.
    """
    edges = edges.select("u", "v")
    nodes = edges.select(F.col("u").alias("node"))
    state, before = saved(edges.filter("u <> v").distinct(), "edges"), None
    for _ in range(most_rounds):
        now = state.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(now) == before or not now[0]:
            break
        before = tuple(now)
        state = saved(_small_star(_large_star(state)), "edges")
    else:
        raise RuntimeError("components did not settle")
    linked = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    alone = nodes.distinct().join(linked.select("node").unionByName(roots.select("node")), "node", "left_anti")
    return linked.unionByName(roots).unionByName(alone.select("node", F.col("node").alias("root")))
