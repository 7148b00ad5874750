"""Connected components of an edge table, in DataFrame steps with durable cuts; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node in edges (a, b): root is the smallest node reachable.

    Alternates large-star and small-star steps, which keep the components and end in stars around the smallest node. The
    number of rounds grows with the logarithm of the longest chain. Each step maps edges to at most as many edges.
    Skewed nodes are safe: the minimum of a node's neighbours is a partial aggregate, the rewiring an equi-join that AQE can split.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "cc")
    known = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        # Large star: neighbours above a node go to the node's minimum.
        large = both.join(low, both["a"] == low["n"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = cut(large, "cc-large")
        # Small star: a node and its lower neighbours go to the lowest of them.
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, large["a"] == low["n"]).select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        new = cut(small, "cc-small")
        drop_cut(large)
        # Order-free sums of the edges say whether anything changed.
        sign = new.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        drop_cut(now)
        now = new
        if sign == known:
            break
        known = sign
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
