"""Catalogue functions: path explode (P1), category summaries (A1) and the
product -> category match in exact and substring form (P2, J2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The text the substring-compatible match searches in is a
# category's product list printed as "CompactBuffer(p1, p2, ..., pn)".
LIST_PREFIX = "CompactBuffer("
LIST_SEPARATOR = ", "
LIST_SUFFIX = ")"

# Keys of the substring match are substrings of up to this length.
GRAM = 8


def explode_paths(catalog: DataFrame, product_col: str = "product", path_col: str = "path") -> DataFrame:
    """``(product, path)`` -> ``(product, level, category)``, one row per path level.

    Levels are split on ``/`` and trimmed; level numbering starts at 1.  A path
    that repeats a level gives two rows for the same (product, category).  An empty
    level before the last is a category of its own (``X//Z`` has the levels ``X``,
    the empty one and ``Z``); trailing empty levels are none.
    """
    path = F.regexp_replace(F.col(path_col), r"[/\s]+$", "")
    return (catalog.where(path != "")
            .select(F.col(product_col).alias("product"), F.posexplode(F.split(path, "/")).alias("pos", "raw"))
            .select("product", (F.col("pos") + 1).alias("level"), F.trim("raw").alias("category")))


def product_categories(catalog_levels: DataFrame) -> DataFrame:
    """Distinct ``(product, category)`` pairs: the match table of the exact mode."""
    return catalog_levels.select("product", "category").distinct()


def category_summary(catalog_levels: DataFrame) -> DataFrame:
    """Per category: number of distinct products and the first and last product
    in sorted order (A1).

    The product list itself stays in long form (``product_categories``): one
    category may hold most products, so it is never gathered into one row.
    """
    return (product_categories(catalog_levels).groupBy("category")
            .agg(F.count("product").alias("n_products"),
                 F.min("product").alias("first_product"),
                 F.max("product").alias("last_product")))


def category_list_segments(catalog_levels: DataFrame) -> DataFrame:
    """``(category, segment)``: the printed product list of a category split at
    its separators.

    Items come from comma-split lines and so hold no comma; such an item occurs
    in the printed list exactly when it occurs in one segment.  Products are
    listed in sorted order, so the first segment carries the list prefix and
    the last one the suffix.
    """
    pc = product_categories(catalog_levels).withColumn("product", F.col("product").cast("string"))
    ends = pc.groupBy("category").agg(F.min("product").alias("_first"), F.max("product").alias("_last"))
    # a left join: only the side with one row per category may be broadcast, never the pairs
    return (pc.where(F.col("category").isNotNull()).join(ends, "category", "left")
            .select("category", F.concat(
                F.when(F.col("product") == F.col("_first"), F.lit(LIST_PREFIX))
                # later segments start with the space that follows a separator comma
                .otherwise(F.lit(LIST_SEPARATOR.lstrip(","))),
                F.col("product"),
                F.when(F.col("product") == F.col("_last"), F.lit(LIST_SUFFIX)).otherwise(F.lit("")),
            ).alias("segment")))


def _grams_of_length(text_col, g: int):
    starts = F.sequence(F.lit(1), F.greatest(F.length(text_col) - g + 1, F.lit(0)))
    # one-argument lambdas: a second parameter would be bound to the element index
    return F.filter(F.transform(starts, lambda i: F.substring(text_col, i, g)), lambda s: F.length(s) == g)


def _grams(text_col, max_len: int):
    """All distinct substrings of ``text_col`` of length 1..max_len."""
    return F.array_distinct(F.concat(*[_grams_of_length(text_col, g) for g in range(1, max_len + 1)]))


def substring_matches(items: DataFrame, catalog_levels: DataFrame, item_col: str = "item") -> DataFrame:
    """Distinct ``(item, category)`` where the item is a substring of the
    category's printed product list (compatibility mode of P2).

    Pairs come from equi-joins.  An item of at most ``GRAM`` characters is its own
    key, and a category that has the key has the item: such items join the distinct
    (key, category) pairs, without any text.  A longer item is keyed by its rarest
    ``GRAM``-character substring, counted over the segments that hold any wanted one,
    so a common prefix does not become a hot key that pairs one item with most
    segments; its candidates are verified with ``contains``.  No item is paired with
    every category, and a segment of s characters gives at most s * ``GRAM`` keys.

    The joins with keys are sort-merge joins: a segment gives many keys, which the
    guess from the size of the catalogue's file leaves out, so that Spark would
    broadcast far more than the limit for broadcasts by way of the driver.
    """
    segs = category_list_segments(catalog_levels)
    wanted = (items.select(F.col(item_col).cast("string").alias("item"))
              .where(F.col("item").isNotNull() & (F.col("item") != ""))
              .distinct())
    short = wanted.where(F.length("item") <= GRAM)
    short_index = segs.select("category", F.explode(_grams(F.col("segment"), GRAM)).alias("item")).distinct()
    short_matches = short.join(short_index.hint("merge"), "item").select("item", "category")

    long_grams = (wanted.where(F.length("item") > GRAM)
                  .select("item", F.explode(_grams_of_length(F.col("item"), GRAM)).alias("key")))
    long_index = (segs.select("category", "segment", F.explode(F.array_distinct(
                      _grams_of_length(F.col("segment"), GRAM))).alias("key"))
                  .join(long_grams.select("key").distinct().hint("merge"), "key", "left_semi"))
    frequency = long_index.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    # a gram that no segment holds rules its item out, whichever key is taken then
    long_keys = (long_grams.join(frequency.hint("merge"), "key", "left").groupBy("item")
                 .agg(F.min(F.struct(F.coalesce(F.col("_n"), F.lit(0)).alias("n"), F.col("key"))).alias("k"))
                 .select("item", F.col("k.key").alias("key")))
    long_matches = (long_keys.join(long_index.hint("merge"), "key").where(F.col("segment").contains(F.col("item")))
                    .select("item", "category").distinct())
    return short_matches.unionByName(long_matches)
