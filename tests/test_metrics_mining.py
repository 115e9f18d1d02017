"""ARI, model selection, frequent itemsets and rules against brute force."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from basketmine.operators.metrics import adjusted_rand_index, ari_table, contingency, join_labelings, marginals
from basketmine.operators.mining import association_rules, fit_fpgrowth, frequent_itemsets, mine_clusters
from basketmine.operators.selection import best_k, best_k_from_trials, select_k_constrained, select_k_kmeans
from basketmine.operators.encode import to_vectors


def c2(n):
    return n * (n - 1) / 2.0


def brute_ari(a, b, first_row_only=False):
    cells: dict = {}
    for x, y in zip(a, b):
        cells[(x, y)] = cells.get((x, y), 0) + 1
    rows, cols = {}, {}
    for (x, y), n in cells.items():
        rows[x] = rows.get(x, 0) + n
        cols[y] = cols.get(y, 0) + n
    index = sum(c2(n) for (x, _), n in cells.items() if (x == 0 or not first_row_only))
    sa, sb = sum(c2(n) for n in rows.values()), sum(c2(n) for n in cols.values())
    exp = sa * sb / c2(len(a))
    den = 0.5 * (sa + sb) - exp
    return math.nan if den == 0 else (index - exp) / den


def labels_df(spark, a, b):
    return spark.createDataFrame(list(zip(range(len(a)), a, b)), "row_id long, label_a int, label_b int")


def test_ari_properties(spark):
    rnd = random.Random(3)
    a = [rnd.randrange(4) for _ in range(200)]
    b = [x if rnd.random() < 0.7 else rnd.randrange(5) for x in a]
    assert adjusted_rand_index(labels_df(spark, a, a)) == pytest.approx(1.0)
    ab = adjusted_rand_index(labels_df(spark, a, b))
    assert ab == pytest.approx(brute_ari(a, b), abs=1e-12)
    assert adjusted_rand_index(labels_df(spark, b, a)) == pytest.approx(ab, abs=1e-12)
    renamed = [(x + 2) % 4 for x in a]
    assert adjusted_rand_index(labels_df(spark, renamed, b)) == pytest.approx(ab, abs=1e-12)
    compat = adjusted_rand_index(labels_df(spark, a, b), compat_first_row=True)
    assert compat == pytest.approx(brute_ari(a, b, True), abs=1e-12)
    assert math.isnan(adjusted_rand_index(labels_df(spark, [0] * 10, [0] * 10)))


def test_join_labelings_and_marginals(spark):
    l1 = spark.createDataFrame([(i, i % 3) for i in range(30)], "row_id long, label int")
    l2 = spark.createDataFrame([(i, i % 2) for i in range(0, 30, 2)], "row_id long, label int")
    j = join_labelings(l1, l2)
    assert j.count() == 15
    cont = contingency(j)
    assert cont.agg(F.sum("n")).first()[0] == 15
    m = {(r.side, r.label): r.n for r in marginals(cont).collect()}
    assert m[("b", 0)] == 15 and sum(v for (s, _), v in m.items() if s == "a") == 15
    t = ari_table(j).first()
    assert t.n == 15


def test_stop_rule(spark):
    trials = [(2, 3, 0.5), (3, 4, 0.6), (4, 5, 0.4), (5, 6, 0.1)]
    assert best_k(trials) == 4
    assert best_k([(2, 3, 0.5), (3, 4, 0.6)]) == 4
    assert best_k([]) == 0
    assert best_k([(2, 3, float("nan")), (3, 4, 0.2), (4, 5, 0.1)]) == 4
    df = spark.createDataFrame(trials, "k int, k_next int, ari double")
    got = best_k_from_trials(df).orderBy("k").collect()
    assert [r.k for r in got] == [2, 3, 4] and {r.best_k for r in got} == {4}
    df2 = spark.createDataFrame([(2, 3, float("nan")), (3, 4, 0.2), (4, 5, 0.1)], "k int, k_next int, ari double")
    assert {r.best_k for r in best_k_from_trials(df2).collect()} == {4}


def test_selection_walks(spark, scratch):
    from test_ckmeans import random_rows, to_df
    df = to_df(spark, random_rows(80, 20, 5))
    best, trials = select_k_constrained(df, 3, 6, iterations=1, seed=1, log_path=f"{scratch}/log")
    rows = [tuple(r) for r in trials.collect()]
    assert best == best_k(rows)
    assert [r[0] for r in rows] == list(range(3, 3 + len(rows)))
    assert spark.read.parquet(f"{scratch}/log").count() == len(rows)
    best_c, trials_c = select_k_constrained(df, 3, 6, iterations=1, seed=1, score_against="centroids")
    assert best_c == best and [tuple(r) for r in trials_c.collect()] == rows
    vocab = [f"c{i}" for i in range(8)]
    vec = to_vectors(df, vocab)
    best2, trials2 = select_k_kmeans(vec, 2, 4, max_iter=3)
    assert best2 == best_k([tuple(r) for r in trials2.collect()])


def brute_itemsets(tx, min_support):
    minc = math.ceil(min_support * len(tx))
    counts: dict = {}
    for t in tx:
        for size in range(1, len(t) + 1):
            for combo in itertools.combinations(sorted(t), size):
                counts[combo] = counts.get(combo, 0) + 1
    return {k: v for k, v in counts.items() if v >= minc}


def test_fpgrowth_against_brute_force(spark):
    rnd = random.Random(1)
    tx = [sorted(set(rnd.sample("abcdefg", rnd.randrange(0, 5)))) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in tx], "items array<string>")
    model = fit_fpgrowth(df, 0.1, 0.3)
    got = {tuple(r["items"]): r.freq for r in frequent_itemsets(model).collect()}
    exp = brute_itemsets(tx, 0.1)
    assert got == exp
    for r in association_rules(model).collect():
        union = tuple(sorted(r.antecedent + r.consequent))
        conf = exp[union] / exp[tuple(r.antecedent)]
        assert r.confidence == pytest.approx(conf)
        assert r.confidence >= 0.3
        assert r.support == pytest.approx(exp[union] / len(tx))
        assert r.lift == pytest.approx(conf / (exp[tuple(r.consequent)] / len(tx)))


def test_itemsets_and_rules_equal_mllib(spark):
    from pyspark.ml.fpm import FPGrowth
    rnd = random.Random(4)
    names = [f"c{i}" for i in range(14)] + ["", "odd name", "é"]
    tx = [rnd.sample(names[:rnd.choice([3, 8, 17])], rnd.randrange(0, 4)) + rnd.sample(names, rnd.randrange(0, 7)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in tx] + [(None,)] * 9, "items array<string>")
    distinct = df.select(F.array_distinct("items").alias("items"))
    for support, confidence in [(0.02, 0.5), (0.2, 0.1), (0.9, 0.2), (1.0, 0.0)]:
        ours, mllib = fit_fpgrowth(df, support, confidence, num_partitions=3), FPGrowth(minSupport=support, minConfidence=confidence).fit(distinct)
        assert sorted((sorted(r["items"]), r.freq) for r in ours.freqItemsets.collect()) == \
            sorted((sorted(r["items"]), r.freq) for r in mllib.freqItemsets.collect())
        rules = [sorted((sorted(r.antecedent), r.consequent, r.confidence, r.lift, r.support) for r in m.associationRules.collect())
                 for m in (ours, mllib)]
        assert len(rules[0]) == len(rules[1])
        for a, b in zip(*rules):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-12)
    assert fit_fpgrowth(df.limit(0), 0.1, 0.1).freqItemsets.count() == 0


def test_itemsets_are_mined_once(spark):
    """The tables of a fit are read without another pass over the transactions."""
    read = spark.sparkContext.accumulator(0)
    rnd = random.Random(2)
    tx = [(rnd.sample("abcdef", rnd.randrange(1, 6)),) for _ in range(50)]

    def seen(row):
        read.add(1)
        return row

    df = spark.createDataFrame(spark.sparkContext.parallelize(tx, 2).map(seen), "items array<string>")
    model = fit_fpgrowth(df, 0.1, 0.1)
    before = read.value
    assert frequent_itemsets(model).count() > 6 and association_rules(model).count() > 6
    assert read.value == before == len(tx)


def test_long_itemsets(spark):
    """Sets of up to nine items: the plans of the levels stay small."""
    rows = [(list("abcdefghi"),)] * 6 + [(["a", "x"],)] * 4
    model = fit_fpgrowth(spark.createDataFrame(rows, "items array<string>").coalesce(1), 0.6, 0.99)
    got = {"".join(sorted(r["items"])): r.freq for r in model.freqItemsets.collect()}
    assert len(got) == 2 ** 9 - 1 and got["a"] == 10 and got["abcdefghi"] == 6
    assert len(model.freqItemsets._jdf.queryExecution().toString()) < 200_000


def test_mine_clusters_uses_cluster_support(spark):
    rows = [(1, ["a", "b"])] * 6 + [(1, ["c"])] * 4 + [(2, ["a"])] * 2 + [(2, ["d"])] * 8
    df = spark.createDataFrame(rows, "cluster_id int, items array<string>")
    sets, rules = mine_clusters(df, [1, 2], min_support=0.5, min_confidence=0.5)
    got = {(r.cluster_id, tuple(r["items"])): r.freq for r in sets.collect()}
    assert got == {(1, ("a",)): 6, (1, ("b",)): 6, (1, ("a", "b")): 6, (2, ("d",)): 8}
    assert {(r.cluster_id, tuple(r.antecedent), tuple(r.consequent)) for r in rules.collect()} == \
        {(1, ("a",), ("b",)), (1, ("b",), ("a",))}


@pytest.mark.parametrize("ratio", [1.0, 2.0, 100.0])
def test_band_mining_equals_per_cluster_fits(spark, ratio):
    rnd = random.Random(8)
    rows = []
    for cid, n in [(0, 40), (1, 90), (2, 200), (3, 7)]:
        pool = list("abcdefgh")[cid:cid + 5]
        rows += [(cid, sorted(set(rnd.sample(pool, rnd.randrange(0, 4))))) for _ in range(n)]
    df = spark.createDataFrame(rows, "cluster_id int, items array<string>")
    sets, rules = mine_clusters(df, [0, 1, 2, 3], 0.15, 0.25, staged=False, band_ratio=ratio)
    got_sets = {(r.cluster_id, tuple(r["items"]), r.freq) for r in sets.collect()}
    got_rules = {(r.cluster_id, tuple(r.antecedent), tuple(r.consequent), round(r.confidence, 12),
                  round(r.lift, 12), round(r.support, 12)) for r in rules.collect()}
    exp_sets, exp_rules = set(), set()
    for cid in range(4):
        model = fit_fpgrowth(df.where(F.col("cluster_id") == cid), 0.15, 0.25)
        exp_sets |= {(cid, tuple(r["items"]), r.freq) for r in frequent_itemsets(model).collect()}
        exp_rules |= {(cid, tuple(r.antecedent), tuple(r.consequent), round(r.confidence, 12),
                       round(r.lift, 12), round(r.support, 12)) for r in association_rules(model).collect()}
    assert got_sets == exp_sets
    assert got_rules == exp_rules


def test_band_mining_keeps_any_category_text(spark):
    names = ["a:b", "12:x", "\u0001odd", "plain", "0000000001:y"]
    rows = [(3, [names[0], names[1]])] * 5 + [(3, [names[2]])] * 3 + [(11, [names[3], names[4]])] * 6
    df = spark.createDataFrame(rows, "cluster_id int, items array<string>")
    sets, _ = mine_clusters(df, [3, 11], 0.3, 0.3, staged=False)
    got = {(r.cluster_id, tuple(r["items"]), r.freq) for r in sets.collect()}
    assert (3, tuple(sorted([names[0], names[1]])), 5) in got
    assert (3, (names[2],), 3) in got
    assert (11, tuple(sorted([names[3], names[4]])), 6) in got
    assert all(c in (3, 11) for c, _, _ in got)


def test_kmeans_labels_and_ids_are_deterministic(spark):
    from test_ckmeans import random_rows, to_df
    from basketmine.operators.kmeans import assign_customer_ids, fit_kmeans, kmeans_labels
    vec = to_vectors(to_df(spark, random_rows(120, 30, 3)), [f"c{i}" for i in range(8)]).cache()
    runs = []
    for _ in range(2):
        labels = kmeans_labels(fit_kmeans(vec, 4, 5, seed=1), vec)
        runs.append(sorted((r.basket_id, r.prediction) for r in labels.collect()))
    assert runs[0] == runs[1]
    ids = [sorted((r.basket_id, r.customer_id) for r in assign_customer_ids(vec.drop("customer_id"), 4, 40).collect())
           for _ in range(2)]
    assert ids[0] == ids[1] and all(1 <= c <= 40 for _, c in ids[0])
