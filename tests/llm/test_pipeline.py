from __future__ import annotations

import zlib

import brute
import numpy as np

import corpus_pipeline
from basketmine.llm import packing, quality, queries, simhash
from basketmine.llm.common import table

SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    rows = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    kept = {r.doc_id for r in quality.quality_rules(table(spark, SF, "documents")).where("kept").collect()}
    assert all(brute.base_statistics(rows[d])[0] >= 50 for d in kept)
    ids = sorted(kept)
    label = brute.components([simhash.fingerprint(rows[d]) for d in ids])
    first = {}
    for d, k in zip(ids, label):
        first.setdefault(k, d)
    ids = sorted(first.values())
    left = {}
    for d, (words, gone) in zip(ids, brute.repeats([(d, rows[d]) for d in ids])):
        if len(gone) < len(words):
            left[d] = " ".join(w for i, w in enumerate(words) if i not in gone)
    left = {d: t for d, t in left.items() if not brute.occurrences(t, items)[1]}
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    got = {}
    for p in corpus_pipeline.run(spark, SF).collect():
        got.setdefault(p.doc_id, []).append((p.start, bytes(p.ids)))
    assert set(got) == set(left)
    for d, text in left.items():
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert b"".join(ids for _, ids in sorted(got[d])) == want


def test_stages_keep_the_columns_of_documents(spark, none):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars", "score")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.count() == 0


def test_registered_queries_have_a_row_per_input(spark):
    expected = {"documents": table(spark, SF, "documents").count(), "pages": table(spark, SF, "pages").count()}
    for name, source in (("op1_decontam", "documents"), ("op3_html", "pages"), ("op6_licenses", "documents"), ("op8_classifier", "documents")):
        assert queries.QUERIES[name](spark, SF).count() == expected[source]
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


def test_packed_digest_is_that_of_the_ids(spark):
    docs = table(spark, SF, "documents")
    ids = {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in packing.pack(docs).collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in queries.QUERIES["op4_packing"](spark, SF).collect()} == ids
