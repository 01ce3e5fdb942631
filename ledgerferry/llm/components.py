"""Connected components of a graph of ids, by alternating stars in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, component): of every id in an edge (a, b), the least id reachable.

    Every round hangs the larger neighbours of an id, then the smaller ones and itself, on the
    least of them; rounds go on until nothing changes, a number that grows with the logarithm of
    the longest path. Least neighbours are aggregates, combined before the shuffle.
    """
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).cast("string")).first()
        if mark == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        before = mark
        # Large star: towards the least of all neighbours and itself, for the larger ones.
        both = now.select("a", "b").union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = now.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # Small star: the smaller neighbours and itself towards the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))
        now = cut(moved.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
