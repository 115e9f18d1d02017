"""Basket encoding: items -> distinct category sets as bit words (P3, J2), category sets ->
sparse binary vectors (P4) and back to names (P5)."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketmine.functions.bitwords import BITS, bit_mask, names, word_bits, word_number, words_for
from basketmine.functions.catalog import explode_paths, product_categories, substring_matches


def catalog_levels(catalog: DataFrame) -> DataFrame:
    """Accept ``(product, path)`` or already exploded ``(product, level, category)``."""
    return catalog if "category" in catalog.columns else explode_paths(catalog)


def match_items(baskets: DataFrame, catalog: DataFrame, mode: str = "exact",
                item_col: str = "item") -> DataFrame:
    """``(item, category)`` match table for the items of ``baskets``.

    ``exact``: item equals the product name.  ``substring``: item occurs in the
    category's printed product list (compatibility mode, see
    ``functions.catalog.substring_matches``).
    """
    levels = catalog_levels(catalog)
    if mode == "exact":
        return product_categories(levels).withColumnRenamed("product", "item")
    if mode == "substring":
        return substring_matches(baskets, levels, item_col)
    raise ValueError(f"unknown match mode {mode!r}")


def basket_categories(baskets: DataFrame, catalog: DataFrame, mode: str = "exact",
                      item_col: str = "item") -> DataFrame:
    """Long form: every basket row with the categories of its item (left join,
    so items without a category and empty baskets keep a NULL category).

    No hint: the match table comes out of an aggregate, so Spark knows its size
    (statically, and exactly at run time under AQE) and broadcasts it only
    below ``spark.sql.autoBroadcastJoinThreshold``; a larger catalogue is a
    shuffle join on the item, with hot items split by AQE's skew handling."""
    matches = match_items(baskets, catalog, mode, item_col)
    return baskets.join(matches.withColumnRenamed("item", item_col), item_col, "left")


def vocabulary_table(catalog: DataFrame) -> DataFrame:
    """``(category, idx)``: the distinct categories, numbered from 0 in sorted order.  The window that
    numbers them sees one row per category."""
    levels = catalog_levels(catalog)
    number = F.row_number().over(Window.orderBy("category")) - 1
    return levels.select("category").distinct().select("category", number.cast("int").alias("idx"))


def item_words(matches: DataFrame, vocab: list[str], n_words: int) -> DataFrame:
    """``(item, _w0, _w1, ...)``: the categories of every matched item as bit words, one row per item."""
    idx = F.array_position(F.lit(vocab) if vocab else F.array().cast("array<string>"), F.col("category")) - 1
    bits = matches.select("item", idx.alias("_idx")).select("item", word_number(F.col("_idx")).alias("_word"), bit_mask(F.col("_idx")).alias("_bit"))
    return bits.groupBy("item").agg(*[F.bit_or(F.when(F.col("_word") == k, F.col("_bit")).otherwise(F.lit(0).cast("bigint"))).alias(f"_w{k}")
                                      for k in range(n_words)])


def encode_bits(baskets: DataFrame, catalog: DataFrame, vocab: list[str], mode: str = "exact",
                keys: tuple[str, ...] = ("basket_id", "customer_id"), item_col: str = "item",
                header: DataFrame | None = None) -> DataFrame:
    """``keys + words``: the distinct categories of each basket as bit words (P3) over ``vocab``, the names of
    all categories (``vocabulary(catalog)``).

    Each line item meets its item's words (one row per line item, whatever its number of categories), and
    the OR over a basket is ``bit_or``: a hash aggregate with one long per word, partial on the map side, so a
    very large basket is one row per map task before the shuffle.  Both joins are left to Spark and AQE.
    A basket none of whose items match has no bit set.  For thousands of categories see ``encode_long``.

    ``header`` (one row per basket with a ``basket_id`` that is not null, e.g. ``basket_id, customer_id``): its rows go
    into the same aggregate as the item rows, without a word of their own, so a basket's words and header
    meet in one shuffle and without a join.  Baskets without item rows come out empty, item rows without a
    header do not come out.
    """
    n = words_for(len(vocab))
    keys = ("basket_id",) if header is not None else tuple(k for k in keys if k in baskets.columns)
    # an item's categories are united by bit_or, so a repeated pair does no harm
    pairs = (catalog_levels(catalog).select(F.col("product").alias("item"), "category") if mode == "exact"
             else match_items(baskets, catalog, mode, item_col))
    match = item_words(pairs, vocab, n)
    rows = baskets.join(match.withColumnRenamed("item", item_col), item_col, "left")
    united = [F.bit_or(f"_w{k}").alias(f"_w{k}") for k in range(n)]
    words = F.array(*[F.coalesce(f"_w{k}", F.lit(0).cast("bigint")) for k in range(n)]).alias("words")
    if header is None:
        return rows.groupBy(*keys).agg(*united).select(*keys, words)
    others = [c for c in header.columns if c != "basket_id"]
    rows = rows.select("basket_id", *[f"_w{k}" for k in range(n)]).unionByName(
        header.withColumn("_header", F.lit(True)), allowMissingColumns=True)
    held = rows.groupBy("basket_id").agg(*united, *[F.max(c).alias(c) for c in others], F.bool_or("_header").alias("_header"))
    return held.where("_header AND basket_id IS NOT NULL").select("basket_id", *others, words)


def encode_long(baskets: DataFrame, catalog: DataFrame, mode: str = "exact", keys: tuple[str, ...] = ("basket_id",),
                item_col: str = "item") -> DataFrame:
    """``keys + word, bits``: the words of each basket that are not empty, a row each; for vocabularies of any size."""
    bits = match_items(baskets, catalog, mode, item_col).join(vocabulary_table(catalog), "category").select(
        F.col("item").alias(item_col), word_number(F.col("idx")).alias("word"), bit_mask(F.col("idx")).alias("bits"))
    bits = bits.groupBy(item_col, "word").agg(F.bit_or("bits").alias("bits"))
    return baskets.join(bits, item_col).groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def decode_words(long_words: DataFrame, vocab: DataFrame, keys: tuple[str, ...] = ("basket_id",)) -> DataFrame:
    """``keys + idx, category`` of every set bit of ``encode_long`` rows (P5): numbers read from the words and
    joined to the vocabulary table."""
    idx = F.transform(word_bits(F.col("bits")), lambda b: b + F.col("word") * BITS)
    return long_words.select(*keys, F.explode(idx).alias("idx")).join(vocab, "idx").select(*keys, "idx", "category")


def encode_baskets(baskets: DataFrame, catalog: DataFrame, mode: str = "exact",
                   keys: tuple[str, ...] = ("basket_id", "customer_id"),
                   item_col: str = "item", header: DataFrame | None = None, vocab: list[str] | None = None) -> DataFrame:
    """``keys + words + items``: the categories of each basket (P3) as bit words (see ``encode_bits``) and as
    sorted names; a basket none of whose items match gets ``items = []``.  The names are read from the
    words row by row and cost nothing where they are not used.  ``vocab``: ``vocabulary(catalog)``, if the
    caller has it."""
    vocab = vocabulary(catalog) if vocab is None else vocab
    return with_names(encode_bits(baskets, catalog, vocab, mode, keys, item_col, header), vocab)


def with_names(encoded: DataFrame, vocab: list[str]) -> DataFrame:
    """``items`` beside ``words``; the vocabulary goes along in the metadata of ``words`` (``names_of``)."""
    words = F.col("words").alias("words", metadata={"vocabulary": list(vocab)})
    others = [c for c in encoded.columns if c not in ("words", "items")]
    return encoded.select(*others, words, names(F.col("words"), vocab).alias("items"))


def names_of(encoded: DataFrame) -> list[str]:
    """The vocabulary that the words of ``encoded`` refer to."""
    found = encoded.schema["words"].metadata.get("vocabulary")
    if found is None:
        raise ValueError("the words column does not tell its vocabulary; see with_names")
    return found


def vocabulary(catalog: DataFrame) -> list[str]:
    """Sorted distinct categories (the vector dimensions).  One value per
    category reaches the driver."""
    levels = catalog_levels(catalog)
    found = [r[0] for r in levels.select("category").distinct().collect()]
    return sorted(found, key=lambda c: c.encode())      # as Spark sorts strings


def vectorizer(vocab: list[str], items_col: str = "items", features_col: str = "features") -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary(vocab, inputCol=items_col, outputCol=features_col, binary=True)


def to_vectors(encoded: DataFrame, vocab: list[str], items_col: str = "items",
               features_col: str = "features") -> DataFrame:
    """Category sets -> sparse binary ``VectorUDT`` of size ``len(vocab)``."""
    return vectorizer(vocab, items_col, features_col).transform(encoded)


def vector_cells(features: Column) -> Column:
    """``array<struct<idx int, value double>>`` of a vector's non-zero cells, without a dense array for sparse vectors."""
    shape = "features struct<type: int, size: int, indices: array<int>, `values`: array<double>>"
    v = F.from_json(F.to_json(F.struct(features.alias("features"))), shape)["features"]
    sparse = F.zip_with(v["indices"], v["values"], lambda i, x: F.struct(i.alias("idx"), x.alias("value")))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("idx"), x.alias("value")))
    return F.filter(F.when(v["type"] == 0, sparse).otherwise(dense), lambda c: c["value"] != 0)


def from_vectors(df: DataFrame, vocab: list[str] | DataFrame, features_col: str = "features",
                 items_col: str = "items", indices_col: str | None = None, key: str = "basket_id", keep: bool = True) -> DataFrame:
    """Binary vectors -> sorted category names (P5), one row per ``key``: the numbers of the set cells joined to
    the vocabulary table ``(category, idx)`` (or a list of names).  ``indices_col``: give the numbers as well;
    ``keep``: join the other columns of ``df`` back."""
    if not isinstance(vocab, DataFrame):
        vocab = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(vocab)], "category string, idx int")
    cells = df.select(key, F.explode_outer(vector_cells(F.col(features_col))).alias("c")).select(key, F.col("c.idx").alias("idx"))
    pair = F.when(F.col("idx").isNotNull(), F.struct("idx", "category"))      # none for a vector without cells
    held = cells.join(vocab, "idx", "left").groupBy(key).agg(F.array_sort(F.collect_list(pair)).alias("_c"))
    out = (df.join(held, key, "left") if keep else held).withColumn(items_col, F.coalesce(F.col("_c.category"), F.array().cast("array<string>")))
    if indices_col:
        out = out.withColumn(indices_col, F.coalesce(F.col("_c.idx"), F.array().cast("array<int>")))
    return out.drop("_c")
