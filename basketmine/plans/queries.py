"""The registered queries: each reads the whole tables of a scale-factor folder (models
train on every order, but for the queries that score the open ones) and returns a DataFrame whose columns are aliased to match ``oracle_sql``.

Arrays are reported as comma-joined sorted text and doubles as rounded values
so that results compare across engines.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmine.functions.catalog import category_summary, explode_paths
from basketmine.operators.ckmeans import (ConstrainedKMeans, ConstrainedKMeansModel, customer_table, draw_seeds,
                                          labels_by_k, seed_rows)
from basketmine.operators.encode import (decode_words, encode_long, from_vectors, match_items, to_vectors, vocabulary,
                                         vocabulary_table)
from basketmine.operators.kmeans import fit_kmeans, kmeans_labels, step_gap, surrogate_customer_ids
from basketmine.operators.metrics import ari_table, contingency, join_labelings, marginals
from basketmine.operators.mining import association_rules, fit_fpgrowth, frequent_itemsets
from basketmine.operators.nearest import nearest_many
from basketmine.operators.selection import best_k_from_trials, select_k_constrained, select_k_kmeans
from basketmine.plans.promote import promote
from basketmine.session import ensure_checkpoint_dir, keep, keep_on_disk
from basketmine.sources import tables
from basketmine.sources.sinks import write_sorted
from basketmine.sources.text import (dense_row_index, parse_basket_lines, parse_incoming_lines, read_catalog,
                                     unique_row_id)

# Fixed parameters of the registered queries.
K = 8                   # clusters of the constrained model
K_NEXT = 9              # second model of the ARI queries
ITERATIONS = 5
SEED = 1
SELECT_LO, SELECT_HI = 6, 9   # k range walked by the selection query
STOP_LO = 5             # from here the walk stops before SELECT_HI at sf0.01 and sf0.1
GLOBAL_SUPPORT = 0.1    # frequent itemsets over all baskets
CLUSTER_SUPPORT = 0.2   # per-cluster mining for promotions
MIN_CONFIDENCE = 0.2
N_CUSTOMERS = 1000      # surrogate customer ids
KMEANS_ITER = 5         # plain k-means for surrogate customer ids
SELECT_KMEANS_ITER = 10 # plain k-means inside the k walk
ROWS_PER_FILE = 250_000 # lines of an exported text file
MANY = 500              # centres of the inverted index
DIGITS = 6              # rounding of mean weights
RATIO_DIGITS = 9        # rounding of ratios built from integer counts


def joined(col: str) -> Column:
    return F.array_join(F.array_sort(F.col(col)), ",")


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return explode_paths(tables.part_catalog(spark, sf))


def baskets(spark: SparkSession, sf: str) -> DataFrame:
    """Every order, encoded: what all models but those of the promotion queries train on."""
    return tables.encoded_orders(spark, sf, catalog(spark, sf))


def model(spark: SparkSession, sf: str, k: int = K) -> ConstrainedKMeansModel:
    return ConstrainedKMeans(k, ITERATIONS, SEED).fit(baskets(spark, sf))


def model_and_incoming(spark: SparkSession, sf: str) -> tuple[ConstrainedKMeansModel, DataFrame]:
    """A model of the orders that are not open, and the open orders: the split is what these queries show."""
    train, inc = tables.encoded_split(spark, sf, catalog(spark, sf))
    return ConstrainedKMeans(K, ITERATIONS, SEED).fit(train), inc


# --- sources, catalogue, encoding -------------------------------------------

def q_catalog_levels(spark, sf):
    return catalog(spark, sf)


def q_category_summary(spark, sf):
    return category_summary(catalog(spark, sf))


def q_basket_items(spark, sf):
    return tables.order_baskets(spark, sf)


def _lines(spark, sf, statuses=None):
    """Orders as basket lines ``(basket_id, customer_id, line)``: their parts in order, comma-separated."""
    items = tables.line_items(spark, sf).groupBy("basket_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.col("item").cast("string"))), ",").alias("line"))
    return tables.orders(spark, sf, statuses).join(items, "basket_id", "left").withColumn("line", F.coalesce("line", F.lit("")))


def _scratch(spark, name):
    """A fresh path in this application's part of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_basket_scan(spark, sf):
    """Basket lines written as text files and read back; the id of a line comes before its first comma."""
    path = _scratch(spark, "baskets")
    lines = _lines(spark, sf)
    lines.select(F.concat_ws(",", F.col("basket_id").cast("string"), "line").alias("value")).write.text(path)
    read = dense_row_index(spark.read.text(path), "line_no")
    # the line's own number is dense; the key it carries tells which order it is
    keyed = read.select(F.substring_index("value", ",", 1).cast("long").alias("basket_id"),
                        F.regexp_replace("value", "^[^,]*,?", "").alias("value"), "line_no")
    return parse_basket_lines(keyed)


def q_catalog_scan(spark, sf):
    """Catalogue lines written as text files and read back."""
    path = _scratch(spark, "catalog")
    part = tables.part_catalog(spark, sf)
    part.select(F.concat(F.col("product").cast("string"), F.lit(", "), "path").alias("value")).write.text(path)
    return read_catalog(spark, path)


def q_incoming_scan(spark, sf):
    """S3: the lines of the open orders, parsed with their customers."""
    return parse_incoming_lines(_lines(spark, sf, tables.OPEN_STATUS))


def q_dense_index(spark, sf):
    """Order keys exported in key order over several files; a line's dense index is its rank."""
    path = _scratch(spark, "keys")
    write_sorted(tables.orders(spark, sf).select("basket_id", "customer_id"), path, "basket_id", fmt="text", rows_per_file=ROWS_PER_FILE)
    read = dense_row_index(spark.read.text(path), "row_id")
    return read.select("row_id", F.col("value").alias("line"))


def q_unique_ids(spark, sf):
    """R2: rows and distinct ids of every customer's orders."""
    read = unique_row_id(tables.orders(spark, sf), "row_id")
    return read.groupBy("customer_id").agg(F.count("row_id").alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))


def q_match_exact(spark, sf):
    baskets = tables.order_baskets(spark, sf)
    m = match_items(baskets, catalog(spark, sf), "exact")
    return baskets.join(m, "item").select("basket_id", "item", "category")


def q_match_substring(spark, sf):
    items = tables.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item"))
    return match_items(items, catalog(spark, sf), "substring").select("item", "category")


def q_basket_encode(spark, sf):
    enc = tables.encoded_orders(spark, sf, catalog(spark, sf))
    return enc.select("basket_id", "customer_id", F.size("items").alias("n_items"), joined("items").alias("categories"))


def q_basket_vectors(spark, sf):
    cat = catalog(spark, sf)
    vocab = vocabulary(cat)
    enc = tables.encoded_orders(spark, sf, cat, vocab=vocab)
    vec = to_vectors(enc, vocab)
    dec = from_vectors(vec.select("basket_id", "features"), vocabulary_table(cat), items_col="decoded", indices_col="indices", keep=False)
    return dec.select("basket_id", F.lit(len(vocab)).alias("vec_size"),
                      F.array_join("indices", ",").alias("vec_indices"), F.array_join("decoded", ",").alias("decoded"))


def q_basket_words(spark, sf):
    """P3, P5 for vocabularies of any size: bit words as long rows, and the categories read back from them."""
    cat = catalog(spark, sf)
    return decode_words(encode_long(tables.line_items(spark, sf), cat), vocabulary_table(cat))


# --- constrained k-means -----------------------------------------------------

def q_seed_rows(spark, sf):
    return seed_rows(tables.orders(spark, sf), K, SEED)


def _distance_sums(distances: DataFrame) -> DataFrame:
    """Per centre: baskets, those at distance NaN, and the sum of the other distances."""
    d = F.col("distance")
    return distances.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.isnan(d).cast("long")).alias("n_nan"),
        F.round(F.sum(F.when(~F.isnan(d), d)), DIGITS).alias("distance"))


def _seeds_scored(spark, sf):
    """All baskets and a model that holds nothing but the seeds (nothing else of it is computed)."""
    enc = keep(baskets(spark, sf))
    return enc, ConstrainedKMeans(K, 0, SEED).fit(enc)


def q_seed_distances(spark, sf):
    enc, m = _seeds_scored(spark, sf)
    return _distance_sums(m.distances(enc))


def q_nearest_seed(spark, sf):
    enc, m = _seeds_scored(spark, sf)
    return m.nearest(enc).select("basket_id", F.col("nearest_cluster").alias("cluster_id"),
                                 F.col("nearest_distance").alias("distance"))


def q_nearest_many(spark, sf):
    """J3 by the inverted index: every order as a set of parts, against the first ``MANY`` orders by seed."""
    sets = keep(tables.order_sets(spark, sf))
    seeds = spark.createDataFrame([(c, items) for c, _, items in draw_seeds(sets, MANY, SEED)], "cluster_id int, items array<bigint>")
    return nearest_many(sets, seeds)


def q_must_link(spark, sf):
    return model(spark, sf).links.select("customer_id", "anchor", "cluster_id")


def q_ckmeans_assign(spark, sf):
    return model(spark, sf).assignments.select(
        "basket_id", "customer_id", "is_seed",
        F.coalesce("seed_cluster", F.lit(-1)).alias("seed_cluster"), "label_0", "cluster_id")


def q_cluster_summary(spark, sf):
    return model(spark, sf).cluster_summary()


def q_ckmeans_centroids(spark, sf):
    return model(spark, sf).centroids.select("cluster_id", "category", F.round("weight", DIGITS).alias("weight"))


def q_centroid_summarizer(spark, sf):
    """A3 by two routes: per cluster the cells of the mean, and those in which category counts and MLlib's
    vector aggregate differ."""
    vocab = vocabulary(catalog(spark, sf))
    m = model(spark, sf)
    other = m.summarized_centroids(vocab).withColumnRenamed("weight", "other")
    both = m.centroids.join(other, ["cluster_id", "category"], "full")
    differ = ~(F.abs(F.col("weight") - F.col("other")) <= 1e-9)
    return both.groupBy("cluster_id").agg(F.count("weight").alias("n_cells"),
                                          F.sum(F.coalesce(differ, F.lit(True)).cast("long")).alias("n_differing"))


def q_centroid_distances(spark, sf):
    enc = keep(baskets(spark, sf))
    m = ConstrainedKMeans(K, ITERATIONS, SEED).fit(enc)
    return _distance_sums(m.distances(enc, score_against="centroids"))


def q_reference_shaped(spark, sf):
    """The vector of every row as index:weight pairs, weights in millionths."""
    vocab = vocabulary(catalog(spark, sf))
    arr = vector_to_array("vector")
    pairs = F.filter(F.transform(arr, lambda x, i: F.when(x > 0, F.concat(
        i.cast("string"), F.lit(":"), F.round(x * 1_000_000).cast("long").cast("string")))), lambda p: p.isNotNull())
    return model(spark, sf).reference_shaped(vocab).select(
        "basket_id", "is_seed", "seed_cluster", "cluster_id", F.array_join(pairs, " ").alias("weights"))


def q_ckmeans_predict(spark, sf):
    m, inc = model_and_incoming(spark, sf)
    return m.predict(inc).select(
        "basket_id", "customer_id", "known_customer", F.col("prediction").alias("cluster_id"))


def q_cluster_members(spark, sf):
    m, inc = model_and_incoming(spark, sf)
    wanted = m.predict(inc).select(F.col("prediction").alias("cluster_id"))
    return m.cluster_baskets(wanted).select("basket_id", "cluster_id")


# --- clustering comparison and selection -------------------------------------

def _two_labelings(spark, sf):
    """Labels under K and K_NEXT, one row per customer weighted with its baskets (``n_baskets``)."""
    enc = keep(baskets(spark, sf).select("basket_id", "customer_id", "words"))     # read for seeds, counts and anchors
    rows, seeds = customer_table(enc, K_NEXT, SEED)
    return labels_by_k(keep(rows), seeds, [K])


def q_contingency(spark, sf):
    return contingency(_two_labelings(spark, sf), weight="n_baskets")


def q_label_marginals(spark, sf):
    return marginals(contingency(_two_labelings(spark, sf), weight="n_baskets"))


def q_labelings_join(spark, sf):
    """Two foreign labelings of the orders (status and year) joined on the row id and counted."""
    o = tables.table(spark, sf, "orders")
    a = o.select(F.col("o_orderkey").alias("row_id"), F.pmod("o_custkey", F.lit(5)).cast("int").alias("label"))
    b = o.select(F.col("o_orderkey").alias("row_id"), F.year("o_orderdate").alias("label"))
    return contingency(join_labelings(a, b))


def _ari(spark, sf, compat):
    t = ari_table(_two_labelings(spark, sf), compat_first_row=compat, weight="n_baskets")
    return t.select("n", "index", "sum_a", "sum_b", F.round("expected", RATIO_DIGITS).alias("expected"),
                    "max_index", F.round("ari", RATIO_DIGITS).alias("ari"))


def q_ari(spark, sf):
    return _ari(spark, sf, False)


def q_ari_compat(spark, sf):
    return _ari(spark, sf, True)


def q_selection_trials(spark, sf):
    best, trials = select_k_constrained(baskets(spark, sf), SELECT_LO, SELECT_HI, ITERATIONS, SEED)
    return trials.select("k", "k_next", F.round("ari", RATIO_DIGITS).alias("ari"), F.lit(best).alias("best_k"))


def q_selection_stop(spark, sf):
    best, trials = select_k_constrained(baskets(spark, sf), STOP_LO, SELECT_HI, ITERATIONS, SEED)
    return trials.select("k", "k_next", F.round("ari", RATIO_DIGITS).alias("ari"), F.lit(best).alias("best_k"))


def _exported(spark, rows: DataFrame, times: int = 1) -> DataFrame:
    """Write key-sorted text (range-partitioned, sorted within files) and read it back with each line's
    place in file order.  With ``times`` 2 a first export of other rows lies at the path and is replaced."""
    path = _scratch(spark, "export")
    for _ in range(times - 1):
        write_sorted(rows.limit(100), path, "basket_id", fmt="text")
    write_sorted(rows, path, "basket_id", fmt="text", rows_per_file=ROWS_PER_FILE)
    return dense_row_index(spark.read.text(path), "line_no").select("line_no", F.col("value").alias("line"))


def q_sorted_export(spark, sf):
    """Key-sorted ``(k,(v1,v2))`` text of the assignments, with the order of the lines."""
    return _exported(spark, model(spark, sf).assignments.select("basket_id", "customer_id", "cluster_id"))


def q_kv_export(spark, sf):
    """Key-sorted ``(k,v)`` text of the assignments that replaces an earlier export."""
    return _exported(spark, model(spark, sf).assignments.select("basket_id", "cluster_id"), times=2)


def q_append_log(spark, sf):
    """The log of selection trials, appended one by one as a walk does."""
    path = _scratch(spark, "trials")
    select_k_constrained(baskets(spark, sf), SELECT_LO, SELECT_HI, ITERATIONS, SEED, log_path=path)
    return spark.read.parquet(path).select("k", "k_next", F.round("ari", RATIO_DIGITS).alias("ari"))


def q_surrogate_ids(spark, sf):
    a = model(spark, sf).assignments.select("basket_id", "cluster_id")
    return surrogate_customer_ids(a, "cluster_id", K, N_CUSTOMERS, SEED, output_col="surrogate_id") \
        .select("basket_id", "cluster_id", "surrogate_id")


def _vectors(spark, sf, store=keep):
    """Basket vectors, cached: the k-means fit and the labelling both read them."""
    cat = catalog(spark, sf)
    return store(to_vectors(baskets(spark, sf), vocabulary(cat)).select("basket_id", "features"))


def q_kmeans_labels(spark, sf):
    """K1, K2: per basket, whether its label is a cluster and how many centres are nearer than its own."""
    vec = _vectors(spark, sf)
    km = fit_kmeans(vec, K, KMEANS_ITER, SEED)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in km.clusterCenters()])   # K x categories values
    x = vector_to_array("features")
    square = F.transform(centres, lambda c: F.aggregate(F.zip_with(c, x, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, y: s + y))
    far = F.col("_d")[F.col("prediction")] - 1e-9
    return (kmeans_labels(km, vec).withColumn("_d", square)
            .select("basket_id", F.col("prediction").between(0, K - 1).alias("is_cluster"),
                    F.size(F.filter("_d", lambda d: d < far)).alias("n_nearer")))


def q_kmeans_step(spark, sf):
    """K1, K2 in numbers: one more iteration of the fit moves every centre to the mean of its members, and the
    training cost is the members' cost."""
    vec = _vectors(spark, sf)
    before, after = (fit_kmeans(vec, K, n, SEED) for n in (KMEANS_ITER, KMEANS_ITER + 1))
    return step_gap(before, after, vec).select("n_clusters", "n_off", (F.col("cost_off") > 1e-9).alias("cost_is_off"))


def q_kmeans_surrogate_ids(spark, sf):
    """K3 on K2: the place of each surrogate id in the range of its cluster, and whether it lies in that range."""
    vec = _vectors(spark, sf)
    km = fit_kmeans(vec, K, KMEANS_ITER, SEED)
    per = N_CUSTOMERS // K
    ids = surrogate_customer_ids(kmeans_labels(km, vec, "label"), "label", K, N_CUSTOMERS, SEED, output_col="surrogate_id")
    place = F.col("surrogate_id") - 1 - F.col("label").cast("long") * per
    return ids.select("basket_id", place.alias("place"), place.between(0, per - 1).alias("in_range"))


def q_kmeans_selection(spark, sf):
    """K9: each model of the walk counted against a fixed labelling of its baskets (which every
    k-means labelling must add up to), and whether the walk ended by the rule."""
    vec = _vectors(spark, sf, keep_on_disk)       # read by some 15 jobs a fit
    first: list = []
    best, trials = select_k_kmeans(vec, SELECT_LO, SELECT_HI, SELECT_KMEANS_ITER, SEED, first=first)
    ruled = best_k_from_trials(trials).agg(
        F.min(F.col("best_k") == best).alias("by_rule"), F.min(F.col("ari").between(-1.0, 1.0)).alias("ari_in_bounds"))
    fixed = F.pmod("basket_id", F.lit(3)).cast("int")
    cells = contingency(first[0].withColumn("fixed", fixed), "label_a", "fixed").groupBy(F.col("label_b").alias("fixed")).agg(
        F.sum("n").alias("n"), (F.max("label_a") < SELECT_LO).alias("in_range"))
    return cells.withColumn("by_rule", F.lit(all(ruled.first())))


# --- mining and promotion ----------------------------------------------------

def q_freq_itemsets(spark, sf):
    fp = fit_fpgrowth(baskets(spark, sf), GLOBAL_SUPPORT, MIN_CONFIDENCE)
    return frequent_itemsets(fp).select(joined("items").alias("items"), "size", "freq")


def q_assoc_rules(spark, sf):
    fp = fit_fpgrowth(baskets(spark, sf), GLOBAL_SUPPORT, MIN_CONFIDENCE)
    return association_rules(fp).select(
        joined("antecedent").alias("antecedent"), joined("consequent").alias("consequent"),
        F.round("confidence", RATIO_DIGITS).alias("confidence"), F.round("lift", RATIO_DIGITS).alias("lift"),
        F.round("support", RATIO_DIGITS).alias("support"))


def q_promote(spark, sf):
    m, inc = model_and_incoming(spark, sf)
    p = promote(m, inc, CLUSTER_SUPPORT, MIN_CONFIDENCE)
    return p.rules.select(
        "cluster_id", joined("antecedent").alias("antecedent"), joined("consequent").alias("consequent"),
        F.round("confidence", RATIO_DIGITS).alias("confidence"), F.round("lift", RATIO_DIGITS).alias("lift"),
        F.round("support", RATIO_DIGITS).alias("support"))


def q_promote_baskets(spark, sf):
    """The cluster of every open order: its promotions are the rows of ``promote`` for that cluster."""
    m, inc = model_and_incoming(spark, sf)
    return m.predict(inc).select("basket_id", "customer_id", F.col("prediction").alias("cluster_id"))


QUERIES = {
    "catalog_levels": q_catalog_levels,
    "category_summary": q_category_summary,
    "basket_items": q_basket_items,
    "basket_scan": q_basket_scan,
    "catalog_scan": q_catalog_scan,
    "incoming_scan": q_incoming_scan,
    "dense_index": q_dense_index,
    "unique_ids": q_unique_ids,
    "match_exact": q_match_exact,
    "match_substring": q_match_substring,
    "basket_encode": q_basket_encode,
    "basket_vectors": q_basket_vectors,
    "basket_words": q_basket_words,
    "seed_rows": q_seed_rows,
    "seed_distances": q_seed_distances,
    "nearest_seed": q_nearest_seed,
    "nearest_many": q_nearest_many,
    "must_link": q_must_link,
    "ckmeans_assign": q_ckmeans_assign,
    "cluster_summary": q_cluster_summary,
    "ckmeans_centroids": q_ckmeans_centroids,
    "centroid_summarizer": q_centroid_summarizer,
    "centroid_distances": q_centroid_distances,
    "reference_shaped": q_reference_shaped,
    "ckmeans_predict": q_ckmeans_predict,
    "cluster_members": q_cluster_members,
    "labelings_join": q_labelings_join,
    "contingency": q_contingency,
    "label_marginals": q_label_marginals,
    "ari": q_ari,
    "ari_compat": q_ari_compat,
    "selection_trials": q_selection_trials,
    "selection_stop": q_selection_stop,
    "sorted_export": q_sorted_export,
    "kv_export": q_kv_export,
    "append_log": q_append_log,
    "surrogate_ids": q_surrogate_ids,
    "kmeans_labels": q_kmeans_labels,
    "kmeans_step": q_kmeans_step,
    "kmeans_surrogate_ids": q_kmeans_surrogate_ids,
    "kmeans_selection": q_kmeans_selection,
    "freq_itemsets": q_freq_itemsets,
    "assoc_rules": q_assoc_rules,
    "promote": q_promote,
    "promote_baskets": q_promote_baskets,
}
