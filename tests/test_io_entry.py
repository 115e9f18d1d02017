"""Sinks, stream scoring, surrogate ids, the promotion plan and the driver contract."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from basketmine.functions.catalog import explode_paths
from basketmine.operators.kmeans import surrogate_customer_ids
from basketmine.operators.ckmeans import ConstrainedKMeans
from basketmine.plans.promote import train_and_promote
from basketmine.plans.queries import QUERIES
from basketmine.sources.sinks import append_trials, write_results, write_sorted
from basketmine.sources.text import parse_catalog_lines
from basketmine.streaming.scoring import score_batch, score_stream, write_batch
from samples import EXAMPLE_LINE, SF_SMALL


def test_write_sorted_text_and_parquet(spark, scratch):
    df = spark.createDataFrame([(k, f"v{k}", k * 2) for k in [5, 3, 9, 1, 7, 2]], "k int, a string, b int")
    write_sorted(df, f"{scratch}/txt", "k", fmt="text", num_partitions=3)
    lines = []
    for part in sorted(glob.glob(f"{scratch}/txt/part-*")):
        with open(part) as fh:
            lines += [x.strip() for x in fh if x.strip()]
    assert lines == [f"({k},(v{k},{k * 2}))" for k in [1, 2, 3, 5, 7, 9]]
    write_sorted(df.select("k", "a"), f"{scratch}/pq", "k", single_file=True)
    assert len(glob.glob(f"{scratch}/pq/part-*")) == 1
    assert [r.k for r in spark.read.parquet(f"{scratch}/pq").collect()] == [1, 2, 3, 5, 7, 9]
    write_sorted(df.select("k", "a").limit(2), f"{scratch}/pq", "k", single_file=True)   # overwrite
    assert spark.read.parquet(f"{scratch}/pq").count() == 2
    write_sorted(df.select("k", "a"), f"{scratch}/kv", "k", fmt="text", single_file=True)
    with open(glob.glob(f"{scratch}/kv/part-*")[0]) as fh:
        assert [x.strip() for x in fh if x.strip()] == [f"({k},v{k})" for k in [1, 2, 3, 5, 7, 9]]
    write_results(df, f"{scratch}/res", partition_by="b")
    assert spark.read.parquet(f"{scratch}/res").count() == 6
    t = spark.createDataFrame([(2, 3, 0.5)], "k int, k_next int, ari double")
    append_trials(t, f"{scratch}/trials")
    append_trials(t, f"{scratch}/trials")
    assert spark.read.parquet(f"{scratch}/trials").count() == 2


def test_surrogate_ids_in_cluster_ranges(spark):
    df = spark.range(500).select(F.col("id").alias("basket_id"), (F.col("id") % 4).cast("int").alias("label"))
    out = surrogate_customer_ids(df, "label", 4, 100, seed=1).collect()
    for r in out:
        assert r.label * 25 + 1 <= r.customer_id <= (r.label + 1) * 25
    assert len({r.customer_id for r in out}) > 60      # all 25 ids of a range are reachable
    with pytest.raises(ValueError):
        surrogate_customer_ids(df, "label", 4, 3)


def _model(spark, catalog_lines_df):
    from test_ckmeans import random_rows
    lv = explode_paths(parse_catalog_lines(catalog_lines_df))
    prods = [r.product for r in lv.select("product").distinct().orderBy("product").collect()]
    rows = random_rows(60, 12, 9)
    long_rows = [(b, c, prods[int(x[1:]) % len(prods)]) for b, c, s in rows for x in sorted(s)] + \
        [(b, c, None) for b, c, s in rows if not s]
    long_form = spark.createDataFrame(long_rows, "basket_id long, customer_id long, item string")
    return lv, long_form


def test_promote_and_stream_scoring(spark, catalog_lines_df, scratch):
    lv, long_form = _model(spark, catalog_lines_df)
    model, promo = train_and_promote(long_form, long_form.where("basket_id < 20"), lv, k=4, iterations=2,
                                     min_support=0.3, min_confidence=0.2)
    per = promo.per_basket()
    clusters = {r.prediction for r in promo.scored.collect()}
    assert {r.cluster_id for r in promo.rules.collect()} <= clusters
    assert per.count() == sum(
        max(1, promo.rules.where(F.col("cluster_id") == c).count()) * promo.scored.where(F.col("prediction") == c).count()
        for c in clusters)

    lines = spark.createDataFrame([(0, 5, EXAMPLE_LINE), (1, 999, "ham,coffee")],
                                  "basket_id long, customer_id long, line string")
    batch = {r.basket_id: r.prediction for r in score_batch(model, lines, lv).collect()}
    src = f"{scratch}/in"
    lines.write.parquet(src)
    stream = spark.readStream.schema(lines.schema).parquet(src)
    q = score_stream(model, stream, lv, f"{scratch}/out", f"{scratch}/ckpt", trigger_once=True)
    q.awaitTermination(120)
    streamed = {r.basket_id: r.prediction for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert streamed == batch


def test_replayed_batch_replaces_itself(spark, scratch):
    df = spark.createDataFrame([(1, 2), (3, 4)], "basket_id long, prediction int")
    write_batch(df, 0, f"{scratch}/scored")
    write_batch(df, 1, f"{scratch}/scored")
    write_batch(df.limit(1), 1, f"{scratch}/scored")
    got = spark.read.parquet(f"{scratch}/scored").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in got} == {0: 2, 1: 1}


def test_promotion_keeps_baskets_without_rules_and_releases_caches(spark, catalog_lines_df):
    lv, long_form = _model(spark, catalog_lines_df)
    spark.catalog.clearCache()
    model, promo = train_and_promote(long_form, long_form.where("basket_id < 20"), lv, k=4, iterations=2, min_support=0.95)
    ids = {r.basket_id for r in long_form.where("basket_id < 20").select("basket_id").collect()}
    assert {r.basket_id for r in promo.per_basket().collect()} == {r.basket_id for r in promo.baskets().collect()} == ids
    promo.rules.count()
    promo.close()
    model.unpersist()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_orders_without_status_are_trained_on(spark, scratch):
    from basketmine.plans import queries as q
    from basketmine.sources import tables
    for name in ("part", "lineitem"):
        os.symlink(f"{SF_SMALL}/{name}.parquet", f"{scratch}/{name}.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus"))) \
        .write.parquet(f"{scratch}/orders.parquet")
    training, incoming = tables.encoded_split(spark, scratch, q.catalog(spark, scratch))
    assert training.count() + incoming.count() == orders.count() == q.baskets(spark, scratch).count()
    assert training.join(incoming, "basket_id").count() == 0
    assert incoming.where("basket_id % 10 = 0").count() == 0
    assert tables.order_baskets(spark, scratch, ["O"], exclude=True).select("basket_id").distinct().count() == training.count()


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["cluster_id", "antecedent", "consequent", "confidence", "lift", "support"]
    assert df.count() >= 0
    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q)
    from basketmine.plans.queries import QUERIES
    assert set(QUERIES) <= set(sql)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle_small(spark, name):
    from oracle_check import compare, duck
    from basketmine.plans.oracle_sql import ORACLE_SQL
    r = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    spark.catalog.clearCache()
    assert r["ok"], r


def test_promote_from_text_on_text(spark, scratch):
    import random
    from samples import CATALOG_LINES, EXAMPLE_CATEGORIES
    from basketmine.plans.promote import promote_from_text
    products = [line.split(",")[0] for line in CATALOG_LINES]
    rnd = random.Random(4)
    lines = [",".join(rnd.sample(products, rnd.randrange(1, 5))) for _ in range(120)] + ["", "unknown thing"]
    with open(f"{scratch}/baskets.txt", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    with open(f"{scratch}/catalog.csv", "w") as fh:
        fh.write("\n".join(CATALOG_LINES) + "\n")
    model, promo = promote_from_text(spark, f"{scratch}/baskets.txt", f"{scratch}/catalog.csv",
                                  [(0, 5, EXAMPLE_LINE)], k=5, id_clusters=4, n_customers=40, min_support=0.2)
    a = model.assignments
    assert a.count() == len(lines)
    assert a.where((F.col("customer_id") < 1) | (F.col("customer_id") > 40)).count() == 0
    scored = promo.scored.collect()
    assert len(scored) == 1 and scored[0]["items"] == EXAMPLE_CATEGORIES
    assert promo.rules.where(F.col("cluster_id") != scored[0].prediction).count() == 0


def test_stream_static_scoring_of_encoded_baskets(spark, scratch):
    from basketmine.streaming.scoring import score_encoded_stream
    from test_ckmeans import random_rows, to_df
    rows = random_rows()
    m = ConstrainedKMeans(5, 2, 1).fit(to_df(spark, rows))
    inc = spark.createDataFrame([(900, rows[0][1], ["c1"]), (901, 999, ["c2", "c3"]), (902, 998, [])],
                                "basket_id long, customer_id long, items array<string>")
    batch = {r.basket_id: (r.prediction, r.known_customer) for r in m.predict(inc).collect()}
    inc.write.parquet(f"{scratch}/enc_in")
    stream = spark.readStream.schema(inc.schema).parquet(f"{scratch}/enc_in")
    q = score_encoded_stream(m, stream, f"{scratch}/enc_out", f"{scratch}/enc_ckpt", trigger_once=True)
    q.awaitTermination(120)
    got = {r.basket_id: (r.prediction, r.known_customer) for r in spark.read.parquet(f"{scratch}/enc_out").collect()}
    assert got == batch
