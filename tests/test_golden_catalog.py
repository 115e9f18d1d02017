"""Golden checks on the full grocery catalogue (counts, the example basket,
and the products that gain categories under substring matching)."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketmine.functions.catalog import explode_paths, product_categories
from basketmine.operators.encode import encode_baskets, to_vectors, vocabulary
from basketmine.sources.text import incoming_baskets, parse_basket_lines, parse_catalog_lines
from samples import EXAMPLE_CATEGORIES, EXAMPLE_LINE
from grocery_catalog import GROCERY_CATALOG

# Products that gain categories when matched as substrings of
# the printed category lists, with the number of categories gained.
SUBSTRING_GAINS = {"cream": 7, "meat": 5, "chocolate": 4, "fish": 4, "oil": 4, "cleaner": 3, "dessert": 3,
                   "salt": 3, "bags": 2, "butter": 2, "ham": 2, "beverages": 1, "chicken": 1, "coffee": 1,
                   "sausage": 1}


def levels(spark):
    lines = spark.createDataFrame([(line,) for line in GROCERY_CATALOG], "value string")
    return explode_paths(parse_catalog_lines(lines))


def test_catalog_counts(spark):
    lv = levels(spark)
    assert lv.select("product").distinct().count() == 169
    assert lv.count() == 448
    assert product_categories(lv).count() == 446
    assert lv.select("category").distinct().count() == 191
    assert lv.where("level = 1").select("category").distinct().count() == 19
    assert lv.where("category = '?'").select("product").distinct().count() == 7


def test_example_basket_golden(spark):
    lv = levels(spark)
    vocab = vocabulary(lv)
    assert len(vocab) == 191
    inc = incoming_baskets(spark, [(0, 5, EXAMPLE_LINE)])
    for mode in ("exact", "substring"):
        enc = encode_baskets(inc, lv, mode)
        row = to_vectors(enc, vocab).first()
        assert row["items"] == EXAMPLE_CATEGORIES
        assert row.features.size == 191 and row.features.numNonzeros() == 12


def test_substring_gains(spark):
    lv = levels(spark)
    products = [line.split(",")[0] for line in GROCERY_CATALOG]
    lines = spark.createDataFrame(list(enumerate(products)), "basket_id long, value string")
    long_form = parse_basket_lines(lines)
    exact = encode_baskets(long_form, lv, "exact").select("basket_id", F.size("items").alias("e"))
    sub = encode_baskets(long_form, lv, "substring").select("basket_id", F.size("items").alias("s"))
    gains = {products[r.basket_id]: r.s - r.e for r in exact.join(sub, "basket_id").collect() if r.s != r.e}
    assert gains == SUBSTRING_GAINS


def test_demo_configuration_end_to_end(spark, scratch):
    """Basket lines without customers + the full catalogue, at the demo
    configuration: 40 k-means clusters for 1,000 surrogate customers, the
    constrained model with k = 40 and 5 iterations, support 0.2, confidence
    0.2, 10 mining partitions; then the example basket of customer 5."""
    import random
    from basketmine.plans.promote import promote_from_text
    products = [line.split(",")[0] for line in GROCERY_CATALOG]
    rnd = random.Random(2)
    weights = [1.0 / (i + 1) for i in range(len(products))]
    lines = [",".join(sorted(set(rnd.choices(products, weights, k=rnd.randrange(1, 8))))) for _ in range(2000)]
    with open(f"{scratch}/basket_lines.txt", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    with open(f"{scratch}/catalog.csv", "w") as fh:
        fh.write("\n".join(GROCERY_CATALOG) + "\n")
    model, promo = promote_from_text(spark, f"{scratch}/basket_lines.txt", f"{scratch}/catalog.csv",
                                  [(0, 5, EXAMPLE_LINE)])
    a = model.assignments
    assert a.count() == 2000 and len(model.seeds) == 40
    assert a.where((F.col("customer_id") < 1) | (F.col("customer_id") > 1000)).count() == 0
    assert a.where(~F.col("is_seed")).groupBy("customer_id").agg(F.countDistinct("cluster_id").alias("c")) \
        .where("c > 1").count() == 0
    scored = promo.scored.first()
    assert scored["items"] == EXAMPLE_CATEGORIES and 0 <= scored.prediction < 40
    members = a.where(~F.col("is_seed") & (F.col("cluster_id") == scored.prediction)).count()
    sets = promo.itemsets.collect()
    assert sets and all(r.cluster_id == scored.prediction and r.freq >= 0.2 * members for r in sets)
    assert promo.rules.where((F.col("confidence") < 0.2) | (F.col("cluster_id") != scored.prediction)).count() == 0
