"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspan.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("sum")
    ).first()
    return row["n"], row["sum"]


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Every edge with the smallest of ``u`` and its neighbours.

    The smallest values are written first: the join then has a plain shuffle on both
    sides, and Spark splits the partition of a node with many edges.
    """
    smallest = written(edges.groupBy("u").agg(F.min("v").alias("m")), "smallest")
    return edges.join(smallest, "u").withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the smallest node.

    Loops and repeated edges make no difference; a node of its own may be given as a
    loop. Each round links neighbours to the smallest one they know and ends in one
    written table, so a lost executor costs one round at most. The number of rounds
    grows with the logarithm of the longest path.
    """
    loops = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node")))
    nodes = loops.distinct()
    turned = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = written(turned.where("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours move to the smallest node in reach.
        large = _with_smallest(written(both, "edges-both"))
        large = large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "edges-large")
        # Then the smaller neighbours of a node.
        small = _with_smallest(large)
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = small.select("u", F.col("m").alias("v"))
        now = written(moved.union(kept).distinct(), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    root = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(root, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
