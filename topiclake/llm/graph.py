"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.llm.common import cut, drop


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node of its component) of every node that an edge ``a``, ``b`` touches.

    Alternates two steps until nothing changes: each node hands its larger neighbours, then its smaller ones, to the
    smallest of its neighbourhood. A neighbourhood is reduced to its minimum before it meets its edges, and is never
    collected; the number of rounds grows with the logarithm of the longest path. Each round is written down.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    last = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last or mark[0] == 0:
            break
        last = mark
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        over, e = e, cut(small.union(least.select("a", F.col("m").alias("b"))).distinct(), 2 * mark[0])
        drop(over)
    leaves = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return leaves.union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct().join(leaves, "node", "left_anti"))
