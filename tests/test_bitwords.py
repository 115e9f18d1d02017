"""Category sets as bit words, the inverted index over centres, the walk in one plan and its log."""

from __future__ import annotations

import contextlib
import io
import random

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from basketmine.functions import bitwords
from basketmine.functions.jaccard import Centres, set_distance
from basketmine.operators.ckmeans import ConstrainedKMeans, customer_label, customer_table, draw_seeds, labels_by_k, set_column
from basketmine.operators.encode import (decode_words, encode_baskets, encode_bits, encode_long, from_vectors, names_of, to_vectors,
                                         vocabulary, vocabulary_table)
from basketmine.operators.kmeans import fit_kmeans, kmeans_labels, step_gap
from basketmine.operators.metrics import adjusted_rand_index
from basketmine.operators.nearest import nearest_many
from basketmine.operators.selection import best_k, select_k_constrained, select_k_kmeans, stops
from basketmine.sources.sinks import append_trials, logged_trials, write_sorted


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue()


def physical(df) -> str:
    text = plan_text(df)
    return text[text.index("== Physical Plan =="):]


def shop(spark, n_categories, n_baskets, seed, per=5):
    """Catalogue, baskets and the categories of each basket."""
    rng = random.Random(seed)
    cats = {f"p{i}": sorted(rng.sample(range(n_categories), rng.randint(1, 3))) for i in range(2 * n_categories)}
    levels = [(p, k + 1, f"c{c:06d}") for p, cs in cats.items() for k, c in enumerate(cs)]
    lines, want = [], {}
    for b in range(n_baskets):
        items = [rng.choice([*cats, "unknown"]) for _ in range(rng.randint(0, per))]
        want[b] = sorted({f"c{c:06d}" for p in items for c in cats.get(p, [])})
        lines += [(b, b % 7 or None, p) for p in items] or [(b, b % 7 or None, None)]
    return (spark.createDataFrame(levels, "product string, level int, category string"),
            spark.createDataFrame(lines, "basket_id long, customer_id long, item string"), want)


def test_words_hold_what_was_packed():
    rng = random.Random(1)
    for n in (1, 63, 64, 65, 200):
        held = sorted(rng.sample(range(n), rng.randint(0, n)))
        words = bitwords.pack(held, bitwords.words_for(n))
        assert bitwords.unpack(words) == held and all(-2 ** 63 <= w < 2 ** 63 for w in words)
    assert bitwords.pack([63], 1) == [-2 ** 63] and bitwords.words_for(0) == 1 and bitwords.words_for(64) == 1 and bitwords.words_for(65) == 2


@pytest.mark.parametrize("n_categories", [5, 64, 150])
def test_encoding_against_brute_force(spark, n_categories):
    levels, lines, want = shop(spark, n_categories, 120, n_categories)
    vocab = vocabulary(levels)
    enc = encode_baskets(lines, levels)
    assert names_of(enc) == vocab and len(vocab) <= n_categories
    rows = enc.withColumn("numbers", bitwords.set_bits(F.col("words"), bitwords.words_for(len(vocab)))) \
        .withColumn("n", bitwords.size(F.col("words"), bitwords.words_for(len(vocab)))).collect()
    assert {r.basket_id: r["items"] for r in rows} == want
    assert all([vocab[i] for i in r.numbers] == r["items"] and r.n == len(r["items"]) and bitwords.unpack(r.words) == r.numbers for r in rows)
    long = encode_long(lines, levels)
    got: dict = {}
    for r in decode_words(long, vocabulary_table(levels)).orderBy("basket_id", "idx").collect():
        got.setdefault(r.basket_id, []).append(r.category)
    assert got == {b: cs for b, cs in want.items() if cs}
    with pytest.raises(ValueError):
        names_of(encode_bits(lines, levels, vocab))


def test_encoding_plan(spark):
    from basketmine.plans import queries as q
    from samples import SF_SMALL
    plan = physical(q.q_basket_encode(spark, SF_SMALL))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "collect_" not in plan and "bit_or" in plan
    assert "merge" not in plan_text(q.q_basket_encode(spark, SF_SMALL)).split("== Analyzed")[0].lower()


def test_a_large_vocabulary_is_decoded_from_a_table(spark):
    n = 100_000
    levels = spark.range(n).select(F.format_string("p%06d", "id").alias("product"), F.lit(1).alias("level"), F.format_string("c%06d", "id").alias("category"))
    lines = spark.range(300).select((F.col("id") % 60).alias("basket_id"), F.format_string("p%06d", (F.col("id") * 331) % n).alias("item"))
    decoded = decode_words(encode_long(lines, levels), vocabulary_table(levels))
    assert len(plan_text(decoded)) < 60_000
    want = sorted((i % 60, i * 331 % n, f"c{i * 331 % n:06d}") for i in range(300))
    assert sorted(map(tuple, decoded.collect())) == want
    from pyspark.ml.linalg import SparseVector, VectorUDT
    from pyspark.sql.types import LongType, StructField, StructType
    vec = spark.createDataFrame([(b, SparseVector(n, sorted({i * 331 % n for i in range(300) if i % 60 == b}), [1.0] * 5)) for b in range(60)]
                                + [(60, SparseVector(n, [], []))], StructType([StructField("basket_id", LongType()), StructField("features", VectorUDT())]))
    back = from_vectors(vec, vocabulary_table(levels), indices_col="numbers")
    assert len(plan_text(back)) < 60_000 and "vector_to_array" not in plan_text(back)
    got = {r.basket_id: list(zip(r.numbers, r["items"])) for r in back.collect()}
    assert got == {b: sorted((i, c) for x, i, c in want if x == b) for b in range(61)}


def test_dense_vectors_and_lists_decode_too(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(1, Vectors.dense([0, 1, 1])), (2, Vectors.sparse(3, [0], [1.0])), (3, Vectors.dense([0, 0, 0]))], ["basket_id", "features"])
    assert {r.basket_id: r["items"] for r in from_vectors(df, ["a", "b", "c"]).collect()} == {1: ["b", "c"], 2: ["a"], 3: []}


def test_distances_on_words_equal_those_on_names(spark):
    levels, lines, _ = shop(spark, 100, 80, 4)
    enc = encode_baskets(lines, levels)
    vocab, rng = names_of(enc), random.Random(5)
    n = bitwords.words_for(len(vocab))
    sets = [sorted(rng.sample(range(len(vocab)), rng.choice([0, 1, 4, 20]))) for _ in range(9)]
    fewer = [s[: len(s) // 2] for s in sets]
    by_name = lambda s: [vocab[i] for i in s]
    for pair in ((Centres([(i, by_name(s), None) for i, s in enumerate(sets)]), Centres([(i, bitwords.pack(s, n), None) for i, s in enumerate(sets)], n)),
                 (Centres([(i, by_name(f), by_name(s)) for i, (f, s) in enumerate(zip(fewer, sets))]),
                  Centres([(i, bitwords.pack(f, n), bitwords.pack(s, n)) for i, (f, s) in enumerate(zip(fewer, sets))], n))):
        both = enc.select(pair[0].distances(F.col("items")).alias("a"), pair[1].distances(F.col("words")).alias("b"),
                          pair[0].nearest(F.col("items")).alias("x"), pair[1].nearest(F.col("words")).alias("y")).collect()
        assert all(repr(r.a) == repr(r.b) and repr(r.x) == repr(r.y) for r in both)
    for r in enc.limit(20).collect():
        for s in sets:
            assert repr(set_distance(by_name(s), r["items"])) == repr(set_distance(bitwords.pack(s, n), r.words))


def test_a_model_on_words_equals_one_on_names(spark):
    levels, lines, _ = shop(spark, 90, 300, 6)
    enc = encode_baskets(lines, levels).cache()
    a, b = (ConstrainedKMeans(6, 5, 2).fit(df) for df in (enc, enc.drop("words")))
    assert set_column(enc) == "words" and a.vocab and b.vocab is None
    for part, columns in (("links", ["customer_id", "anchor", "cluster_id"]), ("centroids", ["cluster_id", "category", "weight"]),
                          ("assignments", ["basket_id", "customer_id", "items", "is_seed", "label_0", "cluster_id"])):
        x, y = (sorted(map(repr, getattr(m, part).select(*columns).collect())) for m in (a, b))
        assert x == y, part
    for against in ("seeds", "centroids"):
        x, y = (sorted(map(tuple, m.predict(df, against).select("basket_id", "prediction").collect())) for m, df in ((a, enc), (b, enc.drop("words"))))
        assert x == y
        x, y = (sorted(map(repr, m.distances(df, against).collect())) for m, df in ((a, enc), (b, enc.drop("words"))))
        assert x == y
    cells = {(r.cluster_id, r.category): r.weight for r in a.centroids.collect()}
    for r in a.summarized_centroids(a.vocab).collect():
        assert abs(cells.pop((r.cluster_id, r.category)) - r.weight) < 1e-12
    assert not cells


def test_closed_form_does_not_grow_with_the_iterations(spark):
    levels, lines, _ = shop(spark, 30, 60, 7)
    enc = encode_baskets(lines, levels).cache()
    many = ConstrainedKMeans(4, 500, 1).fit(enc)
    few, lots = (len(plan_text(ConstrainedKMeans(4, n, 1)._centroids(many.cached[0], many.seeds, many.vocab))) for n in (5, 500))
    assert abs(few - lots) < 100
    rows = many.assignments.select("is_seed", "seed_cluster", "label_0", "cluster_id", "items").collect()
    for c, _, seed in many.seeds:
        held = set(bitwords.unpack(seed))
        weights = {x: float(i in held) for i, x in enumerate(many.vocab)}
        for t in range(500):
            members = [r["items"] for r in rows if not r.is_seed and (r.label_0 if t == 0 else r.cluster_id) == c]
            weights = {x: (w + sum(x in m for m in members)) / (1 + len(members)) for x, w in weights.items()}
        got = {r.category: r.weight for r in many.centroids.where(F.col("cluster_id") == c).collect()}
        assert all(abs(got.get(x, 0.0) - w) < 1e-12 for x, w in weights.items())


def random_sets(spark, n, values, seed, empty=0.1):
    rng = random.Random(seed)
    rows = [(i, [] if rng.random() < empty else sorted(rng.sample(range(values), rng.randint(1, min(6, values))))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "basket_id long, items array<bigint>")


@pytest.mark.parametrize("values", [8, 3000])
def test_inverted_index_equals_all_distances(spark, values):
    rows, baskets = random_sets(spark, 250, values, values)
    centres, _ = random_sets(spark, 40, values, values + 1)
    for some in (centres, [(c, s) for c, s in centres if s], [(7, []), (9, [])]):
        table = spark.createDataFrame([(c + 3, s) for c, s in some], "cluster_id int, items array<bigint>")
        got = {r.basket_id: (r.cluster_id, r.distance) for r in nearest_many(baskets, table).collect()}
        for b, held in rows:
            away = [(d != d, d, c + 3) for c, s in some for d in [set_distance([str(x) for x in s], [str(x) for x in held])]]
            nan, d, c = min(away)
            assert got[b][0] == c and (got[b][1] != got[b][1] if nan else got[b][1] == d)
    assert len(got) == len(rows)


def test_inverted_index_nulls_and_no_centres(spark):
    baskets = spark.createDataFrame([(1, None), (2, ["a"])], "basket_id long, items array<string>")
    centres = spark.createDataFrame([(4, None), (5, ["b"]), (6, ["a", "c"])], "cluster_id int, items array<string>")
    assert {r.basket_id: (r.cluster_id, r.distance) for r in nearest_many(baskets, centres).collect()} == {1: (5, 1.0), 2: (6, 0.5)}
    assert [tuple(r)[1:] for r in nearest_many(baskets, centres.where("false")).collect()] == [(None, None)] * 2


def test_many_centres_are_no_literal(spark):
    _, baskets = random_sets(spark, 20, 3000, 1)
    plans = []
    for k in (5, 500):
        table = spark.createDataFrame([(c, [c, c + 1]) for c in range(k)], "cluster_id int, items array<bigint>")
        plans.append(len(physical(nearest_many(baskets, table))))
    assert abs(plans[1] - plans[0]) < 100


def weighted(df):
    return sorted(map(tuple, df.groupBy("label_a", "label_b").agg(F.sum("n_baskets")).collect()))


def test_labels_of_all_k_in_one_plan(spark):
    levels, lines, _ = shop(spark, 25, 140, 8)
    enc = encode_baskets(lines, levels).cache()
    for baskets in (enc, enc.drop("words")):
        rows, seeds = customer_table(baskets, 12, 3)
        assert len({c for *_, c in seeds if c}) > 3          # customers that own seeds
        together = labels_by_k(rows, seeds, list(range(2, 12))).cache()
        for k in range(2, 12):
            alone = rows.select(customer_label(seeds, k).alias("label_a"), customer_label(seeds, k + 1).alias("label_b"), "n_baskets")
            assert weighted(together.where(F.col("k") == k)) == weighted(alone)
    assert [s[:3] for s in seeds] == draw_seeds(baskets, 12, 3)


def jobs_of(spark, name, action):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    action()
    found = len(sc.statusTracker().getJobIdsForGroup(name))
    sc.setJobGroup("", "")
    return found


def test_a_walk_costs_jobs_per_block_not_per_k(spark):
    levels, lines, _ = shop(spark, 25, 140, 9)
    enc = encode_baskets(lines, levels).cache()
    enc.count()
    results = {b: select_k_constrained(enc, 3, 9, block=b) for b in (1, 2, 16)}
    walks = {b: (best, [tuple(r) for r in trials.collect()]) for b, (best, trials) in results.items()}
    assert walks[1] == walks[2] == walks[16] and walks[1][0] == best_k(walks[1][1])
    one = jobs_of(spark, "walk-3", lambda: select_k_constrained(enc, 3, 4))
    assert jobs_of(spark, "walk-9", lambda: select_k_constrained(enc, 3, 9)) <= one + 1


def test_a_repeated_walk_leaves_each_trial_once(spark, scratch):
    levels, lines, _ = shop(spark, 25, 140, 9)
    enc = encode_baskets(lines, levels).cache()
    path = f"{scratch}/log"
    best, trials = select_k_constrained(enc, 3, 9, log_path=path)
    want = [tuple(r) for r in trials.collect()]
    run = "constrained-seeds-1-1"
    assert logged_trials(spark, path, run) == want and logged_trials(spark, path, "other") == logged_trials(spark, scratch + "/none", run) == []
    again = jobs_of(spark, "walk-again", lambda: select_k_constrained(enc, 3, 9, log_path=path))
    assert again <= 4 and logged_trials(spark, path, run) == want          # the log is read, nothing is computed
    assert spark.read.parquet(path).count() == len(want)
    # a walk that broke off after its first trial goes on behind it
    part = f"{scratch}/part"
    append_trials(spark.createDataFrame(want[:1], "k int, k_next int, ari double"), part, run)
    resumed = select_k_constrained(enc, 3, 9, log_path=part, block=1)
    assert resumed[0] == best and logged_trials(spark, part, run) == want
    # the same record logged twice replaces itself, other runs stay
    append_trials(spark.createDataFrame(want[:1], "k int, k_next int, ari double"), part, run)
    append_trials(spark.createDataFrame([(3, 4, 0.25)], "k int, k_next int, ari double"), part, "other")
    assert logged_trials(spark, part, run) == want and logged_trials(spark, part, "other") == [(3, 4, 0.25)]


def test_a_kmeans_walk_is_taken_up_again(spark, scratch):
    levels, lines, _ = shop(spark, 25, 140, 9)
    enc = encode_baskets(lines, levels)
    vec = to_vectors(enc, names_of(enc)).select("basket_id", "features").cache()
    first: list = []
    best, trials = select_k_kmeans(vec, 3, 6, 5, 1, log_path=f"{scratch}/k", first=first)
    want = [tuple(r) for r in trials.collect()]
    assert first[0].count() == vec.count() and "label_a" in first[0].columns
    again = select_k_kmeans(vec, 3, 6, 5, 1, log_path=f"{scratch}/k")
    assert again[0] == best and [tuple(r) for r in again[1].collect()] == want
    assert all(not stops(b[2], a[2]) for a, b in zip(want, want[1:-1]))


def stored_vectors(spark, monkeypatch) -> list:
    """Gets the columns and the storage level of every frame with vectors that is stored from now on."""
    found: list = []
    frame = type(spark.range(1))
    persist = frame.persist

    def noted(df, storageLevel):
        if "features" in df.columns:
            found.append((df.columns, storageLevel))
        return persist(df, storageLevel)
    monkeypatch.setattr(frame, "persist", noted)
    return found


def test_a_kmeans_walk_stores_its_vectors_once_and_off_the_heap(spark, monkeypatch):
    levels, lines, _ = shop(spark, 25, 140, 9)
    enc = encode_baskets(lines, levels)
    rows = to_vectors(enc, names_of(enc)).select("basket_id", "features")
    vec = spark.createDataFrame(rows.collect(), rows.schema)        # the same order in every run
    stored = stored_vectors(spark, monkeypatch)
    first: list = []
    _, trials = select_k_kmeans(vec, 3, 6, 5, 1, first=first)
    assert stored == [(["basket_id", "features"], StorageLevel.DISK_ONLY)]
    assert vec.storageLevel == StorageLevel.NONE and first[0].storageLevel == StorageLevel.DISK_ONLY
    assert first[0].columns == ["basket_id", "label_a", "label_b"]
    labels = {k: {r.basket_id: r.prediction for r in kmeans_labels(fit_kmeans(vec, k, 5, 1), vec).collect()} for k in range(3, 7)}
    assert {r.basket_id: (r.label_a, r.label_b) for r in first[0].collect()} == {b: (a, labels[4][b]) for b, a in labels[3].items()}
    first[0].unpersist()
    for k, k_next, ari in trials.collect():
        both = spark.createDataFrame([(labels[k][b], labels[k_next][b]) for b in labels[k]], "label_a int, label_b int")
        assert adjusted_rand_index(both) == pytest.approx(ari, abs=1e-12)


def test_the_kmeans_selection_query_stores_ids_and_vectors_only(spark, scratch, monkeypatch):
    from basketmine.plans.queries import q_kmeans_selection
    rnd, sf = random.Random(4), f"{scratch}/kmeans_shop"
    parts = [(p, f"Brand#{p % 5}", f"TYPE{p % 3}") for p in range(20)]
    items = [(o, rnd.randrange(25)) for o in range(1, 60) for _ in range(rnd.randrange(1, 5))]      # order 0 is empty, parts from 20 on are unknown
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string").write.parquet(f"{sf}/part.parquet")
    spark.createDataFrame([(o, o % 9) for o in range(60)], "o_orderkey long, o_custkey long").write.parquet(f"{sf}/orders.parquet")
    spark.createDataFrame(items, "l_orderkey long, l_partkey long").write.parquet(f"{sf}/lineitem.parquet")
    stored = stored_vectors(spark, monkeypatch)
    got = sorted(tuple(r) for r in q_kmeans_selection(spark, sf).select("fixed", "n", "in_range", "by_rule").collect())
    assert got == [(f, 20, True, True) for f in range(3)]
    assert stored == [(["basket_id", "features"], StorageLevel.DISK_ONLY)]


def test_one_more_iteration_is_one_lloyd_step(spark):
    levels, lines, _ = shop(spark, 25, 200, 10)
    enc = encode_baskets(lines, levels)
    vec = to_vectors(enc, names_of(enc)).select("basket_id", "features").repartition(3).cache()
    before, after, later = (fit_kmeans(vec, 5, n, 1) for n in (1, 2, 5))
    row = step_gap(before, after, vec).first()
    assert (row.n_clusters, row.n_off) == (5, 0) and row.cost_off < 1e-9
    row = step_gap(before, later, vec).first()
    assert row.n_off > 0 and row.cost_off > 1e-6


def test_files_follow_the_rows(spark, scratch):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    write_sorted(df, f"{scratch}/out", "k", fmt="text", rows_per_file=30)
    assert spark.read.text(f"{scratch}/out").select(F.input_file_name()).distinct().count() == 4
    write_sorted(df.limit(0), f"{scratch}/none", "k", fmt="text", rows_per_file=30)
    assert spark.read.text(f"{scratch}/none").count() == 0
