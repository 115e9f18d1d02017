from __future__ import annotations

import hashlib
import random
import zlib

import brute
import pytest
from pyspark.sql import functions as F

from basketmine.llm import merkle
from samples import SF_SMALL


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc, text, lang, source, n = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, None if n is None else n + more, text)])


def paths(level):
    """Root of a list of digests, and for each the (bit, sibling or None) of every level."""
    found, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, p in enumerate(at):
            found[i].append((p & 1, level[p ^ 1] if p ^ 1 < len(level) else None))
        at = [p // 2 for p in at]
        level = [h(*level[k:k + 2]) for k in range(0, len(level), 2)]
    return level[0], found


def manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    if not groups:
        return []
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = (members, *paths([leaf(r) for r in members]))
    root, above = paths([trees[g][1] for g in order])
    out = []
    for g, top in zip(order, above):
        members, subroot, below = trees[g]
        for r, path in zip(members, below):
            folded = leaf(r, 1 if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else 0)
            for bit, s in path + top:
                folded = h(s or "", folded) if bit else h(folded, s or "")
            out.append((r[0], leaf(r), subroot, root, h(*[s for _, s in path + top if s]), folded, folded == root))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("stride", [1, 3, merkle.STRIDE])
def test_odd_documents_against_brute_force(spark, odd, stride):
    got = rows_of(merkle.manifest_rows(odd, stride))
    assert got == manifest(brute.odd_documents())
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_sizes_around_powers_of_two(spark):
    rng = random.Random(3)
    for sizes in ([1], [1, 1], [2, 1], [3, 4, 5], [8, 9, 7, 1], [16, 17, 33]):
        rows = [(rng.randrange(10 ** 6), f"t{g}", f"g{g}", None, rng.choice([None, 5])) for g, n in enumerate(sizes) for _ in range(n)]
        df = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
        assert rows_of(merkle.manifest_rows(df, 2)) == manifest(rows)


def test_empty_table_and_largest_number(spark, none):
    assert merkle.manifest_rows(none).count() == 0
    rows = [(k, "x", "en", "s", 2 ** 63 - 1) for k in range(60)]
    got = rows_of(merkle.manifest_rows(spark.createDataFrame(rows, brute.SCHEMA)))
    assert got == manifest(rows) and not all(r[-1] for r in got)


def test_a_group_and_a_key_on_most_rows_are_dealt_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(600).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"),
                                     F.when(F.col("id") < 500, "en").alias("lang"), F.lit("s").alias("source"), F.lit(4).cast("long").alias("n_chars"))
        put = merkle.placed(df, "lang", ["doc_id"])
        assert put.where("lang = 'en'").select(F.spark_partition_id()).distinct().count() >= 1
        assert put.groupBy("lang").agg(F.countDistinct("mk_pos").alias("n"), F.max("mk_pos").alias("m")).where("n = m + 1").count() == 2
        rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
        assert rows_of(merkle.manifest_rows(df, 4)) == manifest(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_any_changed_field_is_noticed(spark):
    rows = [(k, f"text {k}", "en" if k % 3 else "de", "s", k) for k in range(40)]
    df = spark.createDataFrame(rows, brute.SCHEMA)
    for column, value in (("text", F.lit("other")), ("lang", F.lit("fr")), ("source", F.lit(None).cast("string")), ("doc_id", F.lit(99))):
        claimed = df.withColumn("leaf", merkle.leaf_digest()).withColumn(
            "claimed", F.when(F.col("doc_id") == 11, merkle.leaf_digest({column: value})).otherwise(F.col("leaf")))
        made = merkle.build(claimed, "lang", "doc_id", "leaf", ["claimed"], 3)
        wrong = merkle.climb(made, "claimed").where(F.col("mk_folded") != F.lit(made.root))
        assert [r.doc_id for r in wrong.collect()] == [11]
    assert merkle.climb(made).where(F.col("mk_folded") != F.lit(made.root)).count() == 0      # the leaves themselves fold to the root


def test_rows_link_to_their_ancestors(spark):
    rows = [(k, "t", "en", "s", 1) for k in range(21)]
    df = spark.createDataFrame(rows, brute.SCHEMA).withColumn("leaf", merkle.leaf_digest())
    made = merkle.build(df, "lang", "doc_id", "leaf", [], 1)
    node = {(r.mk_tree, r.mk_base, r.mk_pos): r for r in made.nodes.collect()}
    root, _ = paths([leaf(r) for r in rows])
    level = {r.mk_pos: (bytes(r.mk_hash).hex(), (r.mk_up_tree, r.mk_up_base, r.mk_up_pos)) for r in made.leaves.collect()}
    while len(level) > 1:       # with stride 1 every link is to the parent
        for pos, (_, up) in level.items():
            assert up[2] == pos // 2 and bytes(node[up].mk_hash).hex() == h(*[level[q][0] for q in (pos // 2 * 2, pos // 2 * 2 + 1) if q in level])
        level = {up[2]: (bytes(node[up].mk_hash).hex(), (node[up].mk_up_tree, node[up].mk_up_base, node[up].mk_up_pos)) for _, up in level.values()}
    assert {v[0] for v in level.values()} == {root} == {made.root.hex()}


def test_query_against_brute_force_and_sql(spark):
    from basketmine.llm.queries import ORACLE_SQL
    from oracle_check import compare, duck
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert rows_of(merkle.q_merkle(spark, SF_SMALL)) == manifest(rows)
    assert compare(spark, duck(SF_SMALL), "op12_merkle", merkle.q_merkle, ORACLE_SQL["op12_merkle"], SF_SMALL)["ok"]
