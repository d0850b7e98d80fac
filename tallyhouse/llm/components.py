"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import remove, stage

ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 30))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (a, b): root is the smallest node it reaches.

    Each round hangs neighbours on the smallest node in sight, first the larger ones of
    every node, then the smaller; rounds grow with the logarithm of the longest path. A node
    with many neighbours is a minimum combined before the shuffle and a join that Spark may
    split; its neighbours are never gathered. Every round is written to the
    shared folder, and the round before it removed.
    """
    spark = edges.sparkSession
    own = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(own.distinct(), "links")
    before = _state(edges)
    for _ in range(ROUNDS):
        if not before[0]:
            break
        previous = edges
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        large = (
            both.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("root").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        large = stage(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        moved = large.join(least, "a").filter("b <> root")
        moved = moved.select(F.col("b").alias("a"), F.col("root").alias("b"))
        kept = least.select("a", F.col("root").alias("b"))
        edges = stage(moved.union(kept).distinct(), "links")
        remove(spark, large.staged_at)
        remove(spark, previous.staged_at)
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
