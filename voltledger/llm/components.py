"""Connected components of an edge table, by alternating star contractions.

Every step replaces edges by edges to the smallest neighbour (first for larger, then for smaller
neighbours), which keeps the components and makes them stars within a few rounds.  Only (a, b)
pairs are shuffled; minima are combined before the shuffle, and each round is written, so that a
lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.session import stage

MAX_ROUNDS = 50


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """(node, other) pairs with the smallest of a node's others and itself beside them."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least, "node").withColumn("least", F.least("least", "node"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node of its component."""
    forward = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    current, before = stage(forward, "edges"), None
    for _ in range(MAX_ROUNDS):
        both = current.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            current.select(F.col("b").alias("node"), F.col("a").alias("other")))
        large = _to_smallest(both).where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))
        large = large.where("node != other").distinct()
        small = _to_smallest(large)
        stars = small.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(
            small.select(F.col("node").alias("a"), F.col("least").alias("b")))
        current = stage(stars.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        # Equal counts and sums of hashes over two rounds: nothing moved.
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
