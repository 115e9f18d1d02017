"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def _toward_min(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour (or itself) of each node, as a stored table of its own,
    so that the join back onto a hot node's edges can be split."""
    return stored(pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(u, v)``; label is the smallest node reachable.

    Each round links larger neighbours to the smallest neighbour (large star), then
    smaller neighbours (small star); a node's whole neighbourhood is never gathered, only
    its minimum.  The edge set shrinks to one star per component in O(log^2 n) rounds.
    Links are stored in the shared folder after each round.  No edges: no rows.
    """
    spark = edges.sparkSession
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u <> v").distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _toward_min(both)
        large = stored(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u <> v").distinct())
        low2 = _toward_min(large)
        linked = large.join(low2, "u")
        small = stored(linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        sign = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        drop_stored(spark, now, low, large, low2)
        now = small
        if seen == sign:
            break
        seen = sign
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
