"""Jaccard distances, seeds, must-link resolution, centroids and prediction,
checked against a naive in-test loop over the rows in basket order."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketmine.functions.jaccard import dontcare_distance, jaccard_distance, nearest, seed_array
from basketmine.operators.ckmeans import ConstrainedKMeans, draw_seeds

CATS = [f"c{i}" for i in range(8)]


def f32_dist(num, den):
    if den == 0:
        return math.nan
    return float(np.float32(num) / np.float32(den))


def naive_dist(weights: dict, basket: set) -> float:
    """weights: category -> centroid weight; only exact 0 and 1 count."""
    m11 = sum(1 for c, w in weights.items() if w == 1.0 and c in basket)
    m10 = sum(1 for c, w in weights.items() if w == 1.0 and c not in basket)
    m01 = sum(1 for c in basket if weights.get(c, 0.0) == 0.0)
    return f32_dist(m01 + m10, m11 + m01 + m10)


def argmin(dists):
    """(distance, cluster) minimum with NaN after every number."""
    return min(range(len(dists)), key=lambda c: (math.isnan(dists[c]), dists[c] if not math.isnan(dists[c]) else 0, c))


def naive_fit(rows, seed_ids, iterations):
    """rows: [(basket_id, customer, set)] in basket order; seed_ids in cluster order."""
    k = len(seed_ids)
    seed_of = {b: c for c, b in enumerate(seed_ids)}
    items = {b: s for b, _, s in rows}
    seeds = [{c: 1.0 for c in items[b]} for b in seed_ids]
    first: dict = {}
    label0 = {}
    for b, cust, s in rows:
        if b in seed_of:
            label0[b] = seed_of[b]
            continue
        if cust not in first:
            first[cust] = argmin([naive_dist(seeds[j], s) for j in range(k)])
        label0[b] = first[cust]
    link = {}
    for b, cust, _ in rows:
        link[cust] = min(link.get(cust, k), label0[b])
    labels = dict(label0)
    cent = [dict(sd) for sd in seeds]
    for _ in range(iterations):
        new = []
        for j in range(k):
            members = [b for b, _, _ in rows if labels[b] == j]
            acc: dict = {}
            for b in members:
                vec = cent[j] if b in seed_of else {c: 1.0 for c in items[b]}
                for c, w in vec.items():
                    acc[c] = acc.get(c, 0.0) + w
            new.append({c: w / len(members) for c, w in acc.items() if w != 0})
        cent = new
        labels = {b: (seed_of[b] if b in seed_of else link[cust]) for b, cust, _ in rows}
    return label0, labels, cent, link, seeds


def random_rows(n=60, customers=15, rnd_seed=7):
    rnd = random.Random(rnd_seed)
    rows = []
    for b in range(n):
        size = rnd.choice([0, 1, 2, 3, 4]) if b % 11 else 0
        rows.append((b * 3 + 1, rnd.randrange(customers), set(rnd.sample(CATS, size))))
    return rows


def to_df(spark, rows):
    return spark.createDataFrame([(b, c, sorted(s)) for b, c, s in rows],
                                 "basket_id long, customer_id long, items array<string>")


def test_jaccard_cases(spark):
    df = spark.createDataFrame([(["a", "b"], ["a", "b"]), (["a"], ["b"]), ([], []), (["a"], []),
                                (["a", "b", "c"], ["b", "c", "d"])], "x array<string>, y array<string>")
    got = [r.d for r in df.select(jaccard_distance(F.col("x"), F.col("y")).alias("d")).collect()]
    assert got[0] == 0.0 and got[1] == 1.0 and math.isnan(got[2]) and got[3] == 1.0
    assert got[4] == float(np.float32(2) / np.float32(4))
    # fractional weights are "don't care": ones=[a], support=[a, b]; basket {b, c}
    d = spark.createDataFrame([(["a"], ["a", "b"], ["b", "c"])], "o array<string>, s array<string>, b array<string>")
    assert d.select(dontcare_distance(F.col("o"), F.col("s"), F.col("b"))).first()[0] == 1.0


def test_nearest_nan_last_and_ties(spark):
    centres = seed_array([(0, []), (1, ["a"]), (2, ["a"])])
    df = spark.createDataFrame([([],), (["a"],), (["b"],)], "items array<string>")
    got = [tuple(r.n) for r in df.select(nearest(centres, F.col("items")).alias("n")).collect()]
    assert got[0] == (1.0, 1)            # empty vs empty is NaN, sorts after 1.0
    assert got[1] == (0.0, 1)            # tie between 1 and 2 -> lower id
    assert got[2] == (1.0, 0)            # all distances 1.0 -> lowest id


def test_seed_order_is_md5(spark):
    rows = random_rows()
    seeds = draw_seeds(to_df(spark, rows), 5, 1)
    expected = sorted((hashlib.md5(f"1:{b}".encode()).hexdigest(), b) for b, _, _ in rows)[:5]
    assert [b for _, b, _ in seeds] == [b for _, b in expected]
    with pytest.raises(ValueError):
        draw_seeds(to_df(spark, rows), len(rows) + 1, 1)


@pytest.mark.parametrize("iterations", [0, 1, 5])
def test_fit_matches_naive_loop(spark, iterations):
    rows = random_rows()
    df = to_df(spark, rows)
    m = ConstrainedKMeans(5, iterations, 1).fit(df)
    seed_ids = [b for _, b, _ in m.seeds]
    label0, labels, cent, link, _ = naive_fit(rows, seed_ids, iterations)
    got = {r.basket_id: r for r in m.assignments.collect()}
    assert {b: got[b].label_0 for b in got} == label0
    assert {b: got[b].cluster_id for b in got} == labels
    assert {r.customer_id: r.cluster_id for r in m.links.collect()} == link
    got_c = {(r.cluster_id, r.category): r.weight for r in m.centroids.collect()}
    exp_c = {(j, c): w for j, vec in enumerate(cent) for c, w in vec.items()}
    assert got_c.keys() == exp_c.keys()
    for key, w in exp_c.items():
        assert got_c[key] == pytest.approx(w, rel=1e-12, abs=1e-12)


def test_constraints(spark):
    rows = random_rows()
    m = ConstrainedKMeans(5, 3, 1).fit(to_df(spark, rows))
    a = m.assignments
    # every non-seed basket of one customer sits in one cluster
    assert a.where(~F.col("is_seed")).groupBy("customer_id").agg(F.countDistinct("cluster_id").alias("n")) \
        .where("n > 1").count() == 0
    # seeds stay in their own cluster
    assert a.where("is_seed AND seed_cluster != cluster_id").count() == 0
    # link is the lowest cluster among the customer's initial labels
    lowest = a.groupBy("customer_id").agg(F.min("label_0").alias("low"))
    assert m.links.join(lowest, "customer_id").where("low != cluster_id").count() == 0


def test_predict_known_and_unknown(spark):
    rows = random_rows()
    df = to_df(spark, rows)
    m = ConstrainedKMeans(5, 2, 1).fit(df)
    _, _, _, link, seeds = naive_fit(rows, [b for _, b, _ in m.seeds], 2)
    incoming = [(1000, rows[0][1], ["c1"]), (1001, 999, ["c1", "c2"]), (1002, 998, [])]
    inc = spark.createDataFrame(incoming, "basket_id long, customer_id long, items array<string>")
    got = {r.basket_id: (r.prediction, r.known_customer) for r in m.predict(inc).collect()}
    assert got[1000] == (link[rows[0][1]], True)
    for b, cust, items in incoming[1:]:
        exp = argmin([naive_dist(sd, set(items)) for sd in seeds])
        assert got[b] == (exp, False)
    anonymous = {r.basket_id: (r.prediction, r.known_customer) for r in m.predict(inc.drop("customer_id")).collect()}
    for b, _, items in incoming:
        assert anonymous[b] == (argmin([naive_dist(sd, set(items)) for sd in seeds]), False)


def test_same_result_under_partitioning(spark):
    rows = random_rows(80, 20, 11)
    results = []
    for parts in ("1", "4", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        df = to_df(spark, rows).repartition(int(parts))
        m = ConstrainedKMeans(6, 3, 2).fit(df)
        results.append(sorted((r.basket_id, r.cluster_id) for r in m.assignments.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_cluster_baskets_excludes_seeds(spark):
    rows = random_rows()
    m = ConstrainedKMeans(5, 1, 1).fit(to_df(spark, rows))
    wanted = spark.createDataFrame([(0,), (2,)], "cluster_id int")
    got = m.cluster_baskets(wanted).collect()
    assert all(not r.is_seed and r.cluster_id in (0, 2) for r in got)
    exp = m.assignments.where("NOT is_seed AND cluster_id IN (0, 2)").count()
    assert len(got) == exp


def test_reference_shaped_output(spark):
    rows = random_rows()
    m = ConstrainedKMeans(5, 2, 1).fit(to_df(spark, rows))
    _, _, cent, _, _ = naive_fit(rows, [b for _, b, _ in m.seeds], 2)
    out = {r.basket_id: r for r in m.reference_shaped(CATS).collect()}
    items = {b: s for b, _, s in rows}
    seed_of = {b: c for c, b, _ in m.seeds}
    for b, r in out.items():
        vec = r.vector.toArray()
        if b in seed_of:
            assert r.is_seed and r.seed_cluster == seed_of[b]
            assert list(vec) == pytest.approx([cent[seed_of[b]].get(c, 0.0) for c in CATS])
        else:
            assert r.seed_cluster == -1 and list(vec) == [1.0 if c in items[b] else 0.0 for c in CATS]


def test_baskets_without_customer(spark):
    rows = random_rows()
    df = spark.createDataFrame([(b, (c if b % 4 else None), sorted(s)) for b, c, s in rows],
                               "basket_id long, customer_id long, items array<string>")
    m = ConstrainedKMeans(5, 2, 1).fit(df)
    seeds = [set(items) for _, _, items in m.seeds]
    seed_of = {b: c for c, b, _ in m.seeds}
    got = {r.basket_id: r for r in m.assignments.collect()}
    assert m.links.where("customer_id IS NULL").count() == 0
    for b, _, s in rows:
        if b % 4 == 0 and b not in seed_of:
            exp = argmin([naive_dist({c: 1.0 for c in sd}, s) for sd in seeds])
            assert got[b].label_0 == exp and got[b].cluster_id == exp


def test_cluster_summary(spark):
    rows = random_rows()
    m = ConstrainedKMeans(5, 2, 1).fit(to_df(spark, rows))
    a = m.assignments.collect()
    got = {r.cluster_id: (r.n_baskets, r.n_customers, r.n_listed_customers) for r in m.cluster_summary().collect()}
    exp = {}
    for c in range(5):
        final = [r for r in a if r.cluster_id == c]
        listed = {r.customer_id for r in a if r.label_0 == c and r.customer_id is not None}
        exp[c] = (len(final), len({r.customer_id for r in final if r.customer_id is not None}), len(listed))
    assert got == exp


def test_distances_against_float32_on_random_sets(spark):
    rnd = random.Random(21)
    cats = [f"k{i}" for i in range(30)]
    rows = []
    for _ in range(500):
        a = sorted(rnd.sample(cats, rnd.randrange(0, 12)))
        b = sorted(rnd.sample(cats, rnd.randrange(0, 12)))
        support = sorted(set(a) | set(rnd.sample(cats, rnd.randrange(0, 6))))
        rows.append((a, support, b))
    df = spark.createDataFrame(rows, "ones array<string>, support array<string>, b array<string>")
    got = df.select(jaccard_distance(F.col("ones"), F.col("b")).alias("j"),
                    dontcare_distance(F.col("ones"), F.col("support"), F.col("b")).alias("d")).collect()
    for (ones, support, b), r in zip(rows, got):
        exp_j = naive_dist({c: 1.0 for c in ones}, set(b))
        weights = {c: (1.0 if c in ones else 0.5) for c in support}      # fractional weights: don't care
        exp_d = naive_dist(weights, set(b))
        assert (math.isnan(r.j) and math.isnan(exp_j)) or r.j == exp_j
        assert (math.isnan(r.d) and math.isnan(exp_d)) or r.d == exp_d
