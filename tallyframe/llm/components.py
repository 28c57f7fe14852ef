"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import shared


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): the smallest node that each node reaches.

    Each round hangs the larger neighbours of every node on its smallest
    neighbour, then the smaller ones; edges never multiply, and the rounds
    grow with the logarithm of the longest path.  Every round is written to
    the shared folder.
    """
    now = shared(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(down, "a")
        now = shared(hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(down.select("a", F.col("m").alias("b")))
                     .where("a <> b").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
