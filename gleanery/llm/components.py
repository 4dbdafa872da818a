"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a").filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return linked.unionByName(own).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have an edge; component is the smallest node reached.

    edges has two BIGINT columns a and b; loops, repeats and both directions are fine. Each round
    replaces a neighbourhood by a star around its smallest node: aggregates are combined before
    they are shuffled, a node with very many edges sits on one side of a join only (AQE splits
    it), and no neighbourhood is ever collected. Rounds end when no edge changes; their number
    grows with the logarithm of the longest path. Every round is a written table, so lost
    executors never unroll the loop. Nulls link nothing. No edges: no rows.
    """
    now = checkpointed(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if seen == mark or seen[0] == 0:
            break
        mark = seen
        now = checkpointed(_small_star(_large_star(now)))
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
