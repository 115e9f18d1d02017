"""Nearest centre by an inverted index (J3 for many centres).

The literal form (``functions.jaccard.Centres``) compares every basket with every centre.  Here only baskets
and centres that share a category meet: postings of the centres joined on the category, the pairs'
common categories counted, the Jaccard distance made from that count and the two sizes.  A basket
that shares nothing with any centre is settled by sizes alone.  The work follows the postings, not baskets times
centres, and no centre is a literal of the plan: the centres are a table of any size.  Which form to
use is the caller's choice: the index suits sets that are small against their vocabulary (products),
the literal form dense sets (a few categories) and few centres.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmine.functions.jaccard import NAN


def nearest_many(baskets: DataFrame, centres: DataFrame, items_col: str = "items", key: str = "basket_id",
                 cluster_col: str = "cluster_id") -> DataFrame:
    """``key, cluster_id, distance`` of the closest centre of each basket: least distance, then least id; an
    empty basket is at distance 1 of every centre that is not empty and NaN (last) of an empty one.

    ``baskets`` (one row per key) and ``centres`` (one row per id) hold arrays of distinct values in ``items_col``
    (null: empty); more than one row per key or a null key is not meant.

    Baskets are exploded once, to (value, key, size).  A value in a third of all baskets meets its centres'
    postings only, in a join that Spark broadcasts by size or splits by AQE's skew handling, and the
    counts are partial aggregates."""
    size = F.coalesce(F.size(F.col(items_col)), F.lit(0))
    held = F.coalesce(F.col(items_col), F.array().cast(baskets.schema[items_col].dataType))
    sized = centres.select(F.col(cluster_col).alias("cluster_id"), F.when(F.col(items_col).isNull(), F.lit(0)).otherwise(size).alias("_c"),
                           F.col(items_col).alias("_set"))
    postings = sized.select(F.explode("_set").alias("_v"), "cluster_id", "_c")
    rows = baskets.select(F.col(key), F.size(held).alias("_b"), F.explode(held).alias("_v"))
    union = F.col("_b") + F.col("_c") - F.col("_m")
    distance = ((union - F.col("_m")).cast("double") / union.cast("double")).cast("float").cast("double")
    shared = (rows.join(postings, "_v").groupBy(key, "_b", "cluster_id", "_c").agg(F.count(F.lit(1)).alias("_m"))
              .groupBy(key).agg(F.min(F.struct(distance.alias("d"), F.col("cluster_id").alias("cid"))).alias("_near")))
    # nothing shared: any centre is at distance 1 (an empty one too, unless the basket is empty)
    lowest = sized.agg(F.min("cluster_id").alias("any"), F.min(F.when(F.col("_c") > 0, F.col("cluster_id"))).alias("full")).first()
    cid = centres.schema[cluster_col].dataType
    empty = F.size(held) == 0
    alone = F.when(~empty, F.lit(lowest["any"])).otherwise(F.lit(lowest["any"] if lowest["full"] is None else lowest["full"]))
    away = F.when(F.lit(lowest["any"] is None), F.lit(None)).when(empty & F.lit(lowest["full"] is None), F.lit(NAN)).otherwise(F.lit(1.0))
    return (baskets.select(key, alone.cast(cid).alias("_alone"), away.cast("double").alias("_away"))
            .join(shared, key, "left")
            .select(key, F.coalesce("_near.cid", "_alone").alias("cluster_id"), F.coalesce("_near.d", "_away").alias("distance")))
