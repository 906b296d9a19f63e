"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import stored


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _contract(edges: DataFrame) -> DataFrame:
    """One round over edges ``a > b``: every node's larger neighbours move to the
    node's smallest neighbour, then its smaller neighbours do."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (both.join(least, "a").where(F.col("b") > F.col("a"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(down, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(down.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``(a, b)`` that is not the
    smallest of its component; ``root`` is that smallest node.

    Each round is written to the shared scratch folder, so a lost executor
    repeats one round at most. Rounds grow with the logarithm of the longest
    chain. Self-loops and repeated edges do not matter; null ends are ignored.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where(F.col("a") != F.col("b")).distinct(), "edges")
    before = _checksum(now)
    while before[0]:
        now = stored(_contract(now), "edges")
        after = _checksum(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
