"""Sources, catalogue explode, exact/substring matching and encoding."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from basketmine.functions.catalog import (LIST_PREFIX, LIST_SEPARATOR, LIST_SUFFIX, category_summary,
                                          explode_paths, product_categories, substring_matches)
from basketmine.operators.encode import encode_baskets, from_vectors, to_vectors, vocabulary
from basketmine.sources.text import (dense_row_index, incoming_baskets, parse_basket_lines,
                                     parse_catalog_lines, read_basket_lines, read_catalog, rejected_catalog_lines)
from samples import CATALOG_LINES, EXAMPLE_CATEGORIES, EXAMPLE_LINE


def levels(spark, catalog_lines_df):
    return explode_paths(parse_catalog_lines(catalog_lines_df))


def test_catalog_explode(spark, catalog_lines_df):
    lv = levels(spark, catalog_lines_df)
    rows = lv.collect()
    assert len(rows) == 3 * 15 + 1  # 15 three-level paths and one single-level path
    coffee = sorted((r.level, r.category) for r in rows if r.product == "coffee")
    assert coffee == [(1, "Beverages"), (2, "Coffee"), (3, "Coffee")]
    assert product_categories(lv).where("product = 'coffee'").count() == 2
    products = {r.product for r in rows}
    assert "flower (seeds)" in products and "liquor (appetizer)" in products
    summary = {r.category: r for r in category_summary(lv).collect()}
    assert summary["Coffee"].n_products == 2
    assert summary["Coffee"].first_product == "coffee" and summary["Coffee"].last_product == "instant coffee"


def test_read_text_sources(spark, scratch):
    import os
    basket_file = os.path.join(scratch, "baskets.txt")
    with open(basket_file, "w") as fh:
        fh.write("citrus fruit,margarine\n\nunknown thing,ham,ham\nhamburger meat\n")
    cat_file = os.path.join(scratch, "catalog.csv")
    with open(cat_file, "w") as fh:
        fh.write("\n".join(CATALOG_LINES) + "\n")
    b = read_basket_lines(spark, basket_file).collect()
    by_id: dict[int, list] = {}
    for r in b:
        by_id.setdefault(r.basket_id, []).append(r.item)
    assert sorted(by_id) == [0, 1, 2, 3]
    assert by_id[1] == [None]                      # empty line -> empty basket
    assert sorted(by_id[2]) == ["ham", "ham", "unknown thing"]
    cat = read_catalog(spark, cat_file)
    assert cat.count() == len(CATALOG_LINES)
    assert cat.where("product = 'citrus fruit'").first().path == "Fruits-Vegetables/Fresh-Fruits/Citrus"


def test_dense_row_index(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumn("x", F.col("id") * 3)
    idx = dense_row_index(df, "rid").collect()
    assert sorted(r.rid for r in idx) == list(range(1000))
    assert all(r.rid == r.id for r in idx)   # file/range order is kept


def test_dense_row_index_follows_file_order(spark, scratch):
    lines = []
    for name, n in (("a", 10), ("b", 2000), ("c", 50)):     # Spark puts the large file first
        own = [f"{name}{i}" for i in range(n)]
        lines += own
        with open(f"{scratch}/{name}.txt", "w") as fh:
            fh.write("\n".join(own) + "\n")
    got = {r.rid: r.value for r in dense_row_index(spark.read.text(scratch), "rid").collect()}
    assert got == dict(enumerate(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")     # several blocks in one file
    try:
        got = {r.rid: r.value for r in dense_row_index(spark.read.text(scratch), "rid").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == dict(enumerate(lines))


def test_catalogue_lines_without_path_are_not_dropped(spark):
    lines = spark.createDataFrame([("a, X/Y",), ("no path",), (None,)], "value string")
    assert [r.value for r in rejected_catalog_lines(lines).collect()] == ["no path"]
    with pytest.raises(Exception, match="catalogue line without a path"):
        parse_catalog_lines(lines).collect()


def test_empty_levels(spark):
    paths = spark.createDataFrame([("p", "X//Z"), ("q", "/X"), ("r", "X/ /"), ("s", ""), ("t", None)], "product string, path string")
    got = sorted((r.product, r.level, r.category) for r in explode_paths(paths).collect())
    assert got == [("p", 1, "X"), ("p", 2, ""), ("p", 3, "Z"), ("q", 1, ""), ("q", 2, "X"), ("r", 1, "X")]


def test_example_basket_exact_and_substring(spark, catalog_lines_df):
    lv = levels(spark, catalog_lines_df)
    inc = incoming_baskets(spark, [(0, 5, EXAMPLE_LINE)])
    for mode in ("exact", "substring"):
        enc = encode_baskets(inc, lv, mode).collect()
        assert len(enc) == 1 and enc[0].customer_id == 5
        assert enc[0]["items"] == EXAMPLE_CATEGORIES


def test_exact_vs_substring_collisions(spark, catalog_lines_df):
    lv = levels(spark, catalog_lines_df)
    lines = spark.createDataFrame([(0, "cream"), (1, "ham"), (2, "butter"), (3, "nothing here"), (4, "")],
                                  "basket_id long, value string")
    long_form = parse_basket_lines(lines)
    exact = {r.basket_id: r["items"] for r in encode_baskets(long_form, lv, "exact").collect()}
    sub = {r.basket_id: r["items"] for r in encode_baskets(long_form, lv, "substring").collect()}
    assert exact[0] == ["Dairy-Eggs-Cheese", "Milk-Cream", "Whipping-Cream"]
    assert set(sub[0]) - set(exact[0]) == {"Butter-Sour-Cream", "Sour-Cream"}
    assert set(sub[1]) - set(exact[1]) == {"Beef", "Ground-Beef"}
    assert set(sub[2]) - set(exact[2]) == {"Milk-Cream", "Buttermilk"}
    assert exact[3] == [] and sub[3] == [] and exact[4] == [] and sub[4] == []


def brute_force_substring(items, catalog_lines):
    cats: dict[str, list[str]] = {}
    for line in catalog_lines:
        product, path = line.split(",")[0], line.split(",")[1]
        for c in path.split("/"):
            c = c.strip()
            if product not in cats.setdefault(c, []):
                cats[c].append(product)
    out = set()
    for c, prods in cats.items():
        text = LIST_PREFIX + LIST_SEPARATOR.join(sorted(prods)) + LIST_SUFFIX
        for it in items:
            if it and it in text:
                out.add((it, c))
    return out


def test_substring_against_brute_force(spark, catalog_lines_df):
    lv = levels(spark, catalog_lines_df)
    items = ["cream", "ham", "a", "e", "er", " coffee", "Compact", "ready soups)", "(seeds)", "milk", "x",
             "ffer(butter", "citrus fruit", "soups)", "liquor (appetizer)"]
    df = spark.createDataFrame([(i,) for i in items], "item string")
    got = {(r.item, r.category) for r in substring_matches(df, lv).collect()}
    assert got == brute_force_substring(items, CATALOG_LINES)


def test_vectors_round_trip(spark, catalog_lines_df):
    lv = levels(spark, catalog_lines_df)
    vocab = vocabulary(lv)
    inc = incoming_baskets(spark, [(0, 5, EXAMPLE_LINE), (1, 6, "nothing")])
    vec = to_vectors(encode_baskets(inc, lv), vocab)
    rows = {r.basket_id: r for r in vec.collect()}
    assert rows[0].features.size == len(vocab)
    assert rows[0].features.numNonzeros() == 12 and rows[1].features.numNonzeros() == 0
    back = {r.basket_id: r["decoded"] for r in from_vectors(vec, vocab, items_col="decoded").collect()}
    assert back[0] == EXAMPLE_CATEGORIES and back[1] == []


def test_substring_random_items_against_brute_force(spark, catalog_lines_df):
    import random
    rnd = random.Random(11)
    texts = []
    for line in CATALOG_LINES:
        product = line.split(",")[0]
        texts += [LIST_PREFIX + product + LIST_SUFFIX, " " + product, product + LIST_SUFFIX]
    items = set()
    while len(items) < 300:
        t = rnd.choice(texts)
        i = rnd.randrange(len(t))
        piece = t[i:i + rnd.randrange(1, 12)]
        if rnd.random() < 0.2:
            piece += rnd.choice("xyz")
        if "," not in piece:
            items.add(piece)
    lv = levels(spark, catalog_lines_df)
    df = spark.createDataFrame([(i,) for i in sorted(items)], "item string")
    got = {(r.item, r.category) for r in substring_matches(df, lv).collect()}
    assert got == brute_force_substring(sorted(items), CATALOG_LINES)


def test_parse_trim_unique_ids_and_single_product_segment(spark, catalog_lines_df):
    from basketmine.functions.catalog import category_list_segments
    from basketmine.sources.text import unique_row_id
    lines = spark.createDataFrame([(0, " ham , coffee,,"), (1, ",")], "basket_id long, value string")
    raw = sorted((r.basket_id, r.item) for r in parse_basket_lines(lines).collect())
    assert raw == [(0, " coffee"), (0, " ham "), (1, None)]
    trimmed = sorted((r.basket_id, r.item) for r in parse_basket_lines(lines, trim=True).collect())
    assert trimmed == [(0, "coffee"), (0, "ham"), (1, None)]
    ids = [r.row_id for r in unique_row_id(spark.range(50).repartition(3)).collect()]
    assert len(set(ids)) == 50
    segs = {(r.category, r.segment) for r in category_list_segments(levels(spark, catalog_lines_df)).collect()}
    assert ("Flowers", "CompactBuffer(flower (seeds))") in segs          # one product: prefix and suffix
    assert ("Coffee", "CompactBuffer(coffee") in segs and ("Coffee", " instant coffee)") in segs


def test_substring_items_around_the_key_length(spark, catalog_lines_df):
    from basketmine.functions.catalog import GRAM
    texts = [LIST_PREFIX + line.split(",")[0] + LIST_SUFFIX for line in CATALOG_LINES]
    texts += [" " + line.split(",")[0] for line in CATALOG_LINES]
    items = sorted({t[i:i + n] for t in texts for n in range(GRAM - 1, GRAM + 3) for i in range(0, len(t) - n + 1, 3)})
    df = spark.createDataFrame([(i,) for i in items], "item string")
    got = [(r.item, r.category) for r in substring_matches(df, levels(spark, catalog_lines_df)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_force_substring(items, CATALOG_LINES)


def test_substring_match_broadcasts_no_keys_and_verifies_few_pairs(spark, scratch):
    """Keys are many more than Spark guesses from the catalogue's file, so no plan may send them (or the pairs of
    product and category) through the driver; and numbers of few digits have few short keys to meet on."""
    spark.range(100000, 103000).selectExpr("id AS product", "concat('T', id % 3, '/B', id % 7) AS path").write.parquet(f"{scratch}/part")
    lv = explode_paths(spark.read.parquet(f"{scratch}/part"))
    out = substring_matches(spark.range(100000, 103000).selectExpr("id AS item"), lv)
    assert out.count() == out.distinct().count() == 2 * 3000
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastNestedLoopJoin" not in plan
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert all("LeftOuter, BuildRight" in line and "[category#" in line for line in joins), joins
    verified = [line for line in plan.splitlines() if "Contains(" in line and "Join" in line]
    assert len(verified) == 1 and "SortMergeJoin" in verified[0]
    from basketmine.functions.catalog import GRAM
    assert GRAM > len("103000")       # the items are keys themselves: no pair is left to verify
