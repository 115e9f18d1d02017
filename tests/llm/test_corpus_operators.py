from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from basketmine.llm import classifier, katz, packing, simhash, substring
from basketmine.llm.common import SPACE_SPLIT, joined_bytes, word_hashes, word_spans
from basketmine.llm.components import components


def test_word_hashes_tell_words_apart():
    texts = [t for _, t, *_ in brute.odd_documents()]
    data, offsets = joined_bytes(texts)
    start, end, doc = word_spans(data, offsets, SPACE_SPLIT)
    words = [data[a:b].tobytes() for a, b in zip(start, end)]
    assert words == [w.encode() for t in texts for w in brute.SPACED.findall(t or "")]
    h = word_hashes(data, start, end).tolist()
    assert len(set(zip(h, words))) == len(set(h)) == len(set(words))
    alone = joined_bytes(["zz " + words[5].decode()])
    s, e, _ = word_spans(*alone, SPACE_SPLIT)
    assert word_hashes(alone[0], s, e)[1] == h[5]


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(2000, 2001), (2001, 2002), (2002, 2000), (5, 5)]
    edges += [(rng.randint(3000, 3100), rng.randint(3000, 3100)) for _ in range(60)]
    rng.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {n: n for e in edges for n in e}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_fingerprint_is_the_majority_of_spark_xxhash64(spark):
    for text in ("One two THREE four five two three", "Just Two", "Ünï x"):
        words = brute.SPACED.findall(brute.low(text))
        shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [r[0] for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) & (2 ** 64 - 1) == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def near_fingerprints():
    rng = random.Random(4)
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    centre = [rng.getrandbits(64) for _ in range(6)]
    fps = set(centre) | {0, 7, 2 ** 64 - 1}
    fps |= {flip(centre[0], rng.randint(1, 5)) for _ in range(250)} | {flip(centre[1], rng.randint(1, 4)) for _ in range(60)}
    fps |= {flip(centre[2] , 3), flip(centre[3], 4), flip(centre[4], 1)} | {rng.getrandbits(64) for _ in range(40)}
    return [f - 2 ** 64 if f >> 63 else f for f in sorted(fps)]


@pytest.mark.parametrize("bucket, block", [(64, 1024), (3, 10)])
def test_links_connect_what_is_within_three_bits(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "BLOCK", block)
    fps = near_fingerprints()
    links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    label = dict(zip(fps, brute.components(fps)))
    assert all(label[r.u] == label[r.v] for r in links)
    parent = {f: f for f in fps}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for r in links:
        parent[root(r.u)] = root(r.v)
    assert len({root(f) for f in fps}) == len(set(label.values()))


def test_simhash_groups_and_survivors(spark, odd, none):
    rows = brute.odd_documents()
    label = brute.components([simhash.fingerprint(t) for _, t, *_ in rows])
    least = {k: min((d for (d, *_), n in zip(rows, label) if n == k and d is not None), default=None) for k in label}
    got = simhash.simhash_groups(odd).collect()
    assert sorted(map(repr, ((r.doc_id, r.component_id) for r in got))) == sorted(repr((r[0], least[k])) for r, k in zip(rows, label))
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(set(least.values()), key=repr)
    assert simhash.simhash_groups(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_keep_one_keeps_a_row_of_each_group_when_doc_ids_repeat(spark):
    copies, other = brute.invented(80, 31), [brute.invented(80, 40 + i) for i in range(8)]
    rows = [(None, other[0]), (None, other[1]), (None, other[1]), (None, None), (None, ""), (None, copies),  # unrelated null ids
            (1, other[2]), (1, other[3]), (1, other[3]),                                                  # unrelated texts of one id
            (2, copies), (3, copies), (3, other[4]), (4, other[5]), (4, copies),                          # first of one group, later of another
            (5, other[6]), (6, other[6]), (6, other[6]), (7, other[7])]
    label = brute.components([simhash.fingerprint(t) for _, t in rows])
    first = {}
    for (d, t), k in zip(rows, label):
        row = (d is None, d or 0, t or "")
        first[k] = min(first.get(k, row), row)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("clash")).repartition(3)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert got == sorted(first.values()) and len(got) == len(set(label)) == 10


@pytest.mark.parametrize("parts", [1, 5])
def test_substring_against_brute_force(spark, odd, none, parts):
    rows = [(d, t) for d, t, *_ in brute.odd_documents()]
    want = sorted((repr((d, len(w), sorted(g), [x for i, x in enumerate(w) if i not in g]))
                   for (d, _), (w, g) in zip(rows, brute.repeats(rows))))
    done = substring.remove_repeats(odd, parts).collect()
    got = sorted(repr((r.doc_id, r.ss_n_words, [i for s in r.ss_removed for i in range(s.start, s.stop)],
                       brute.SPACED.findall(r.ss_text or ""))) for r in done)
    assert got == want
    untouched = [r for r in done if not r.ss_removed]
    assert all(r.ss_text == r.text for r in untouched)
    assert substring.remove_repeats(none, parts).count() == 0


@pytest.mark.parametrize("parts", [1, 23])
def test_katz_against_dictionaries(spark, odd, none, parts, tmp_path):
    rows = [(d, t) for d, t, *_ in brute.odd_documents()] + [(500 + i, "the of the " * 40 + brute.invented(30, i)) for i in range(20)]
    held = lambda d: None if d is None else d % 4 == 2
    docs = spark.createDataFrame([(d, t, held(d), "clash") for d, t in rows], "doc_id long, text string, held_out boolean, _chunk string")
    tokens = [brute.SPACED.findall(brute.low(t)) + ["</e>"] for _, t in rows]
    model = brute.Katz([w for (d, _), w in zip(rows, tokens) if held(d) is False], katz.discounts, katz.count_classes, katz.CUT)
    want = sorted(((d if d is not None else -1, len(w), sum(model.c[x] > 0 for x in w), round(model.base(w), 5), round(model.score(w), 5))
                   for (d, _), w in zip(rows, tokens)))
    got = katz.katz_scores(docs, parts=parts).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, round(r.base_score, 5), round(r.score, 5)) for r in got) == want
    assert {r.train_tokens for r in got} == {model.n}
    assert all(r.held_out == (held(r.doc_id) is not False) for r in got)
    for u in ("<s>", "the", tokens[5][0]):  # exactly normalised
        assert abs(sum(model.p(u, w) for w in model.c) + model.p(u, "\0") - 1) < 1e-9
    assert katz.katz_scores(docs.where("false"), parts=parts).count() == 0
    unlearned = katz.katz_scores(docs.withColumn("held_out", F.lit(True)), parts=parts).collect()
    assert len(unlearned) == len(rows) and all(np.isfinite([r.score, r.base_score]).all() and r.n_known == 0 for r in unlearned)


def test_katz_tables(spark, odd, tmp_path):
    docs = odd.select("doc_id", "text", F.lit(False).alias("held_out"))
    katz.katz_tables(docs, str(tmp_path / "lm"), parts=4)
    words, pairs, contexts = (spark.read.parquet(str(tmp_path / "lm" / x)) for x in ("words", "bigrams", "contexts"))
    total = words.agg(F.sum("count")).first()[0]
    assert total == pairs.agg(F.sum("count")).first()[0] == sum(len(brute.SPACED.findall(t or "")) + 1 for _, t, *_ in brute.odd_documents())
    # seen mass and freed mass add up to one in every context
    one = pairs.join(contexts.groupBy("context").agg(F.first("denominator").alias("denominator"), F.first("total").alias("total")), "context")
    mass = one.groupBy("context").agg((F.sum("discounted") / F.first("denominator")).alias("m"), F.sum("count").alias("n"), F.first("total").alias("total"))
    assert mass.where("m >= 1 or m <= 0 or n <> total").count() == 0


def test_packing_round_trip(spark, odd, none):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    hard = ["it's we'll DON'T. U.S.A., e.g. x.y. ..., a.b", "İstanbul ǰ J̌ H̱ é ﬁ ½ ① 北京 🙂🙂 x y z w", "<|endoftext|> mid<|startoftext|>dle <|ENDOFTEXT|>",
            "tab\tsep\x0bver\x0cform\r\nnew", "a" * 3000, "," * 50 + ". ,.", "'S 's 'll x's. 'Re,", "́start e ́"]
    rows = [(d, t) for d, t, *_ in brute.odd_documents()] + [(200 + i, t) for i, t in enumerate(hard)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, offset string").repartition(2)
    pieces = packing.pack(docs, keep=["doc_id", "text"], window=512, block_tokens=9000).collect()
    for text in {t for _, t in rows}:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        mine = sorted((p for p in pieces if p.text == text), key=lambda p: (p.start, p.sequence_id))
        copies = sum(t == text for _, t in rows)
        assert all(bytes(p.ids) == ids[p.start:p.start + p.length].tobytes() and p.doc_tokens == len(ids) for p in mine)
        assert sum(p.length for p in mine) == copies * len(ids)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 512
    assert packing.pack(none.select("doc_id", "text")).count() == 0


def test_best_fit_decreasing_takes_the_tightest_window():
    rng = random.Random(2)
    lengths = [rng.randint(1, 100) for _ in range(400)]
    places, count = packing.best_fit_decreasing(lengths, 100)
    room, want = [], {}
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[k]]
        if fits:
            room.remove(min(fits))
        room.append((min(fits) if fits else 100) - lengths[k])
        want[k] = (min(fits) if fits else 100)
    assert count == len(room) and [100 - o for _, o in places] == [want[k] for k in range(len(lengths))]
    assert packing.best_fit_decreasing([], 100) == ([], 0)


def test_classifier_learns_and_scores_everything(spark, odd, none):
    good = [(i, ". ".join(brute.invented(12, i * 7 + k).capitalize() for k in range(8)) + ".") for i in range(300)]
    bad = [(1000 + i, " | ".join(brute.invented(60, i).split())) for i in range(150)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d < 1000), 0) for d, _ in good + bad if d % 3] + [(5, None, 0), (99999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    vectors = classifier.document_vectors(docs)
    model = classifier.train(vectors, labels, F.col("doc_id") % 5 == 0)
    scored = classifier.score_vectors(vectors, model).collect()
    assert np.mean([(r.score >= 0.3) == (r.doc_id < 1000) for r in scored if r.doc_id % 5 == 0]) > 0.98
    everything = classifier.score_vectors(classifier.document_vectors(odd), model).collect()
    assert len(everything) == len(brute.odd_documents()) and all(0 <= r.score <= 1 for r in everything)
    assert classifier.document_vectors(none).count() == 0
    empty = classifier.train(vectors, labels.where("false"), F.lit(False))
    assert {r.score for r in classifier.score_vectors(vectors, empty).collect()} == {0.5}


def test_flat_trees_equal_recursive_descent():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = classifier.fit_trees(x, y, trees=20)

    def walk(k, row):
        while t.left[k] != k:
            k = t.left[k] if row[t.feature[k]] <= t.threshold[k] else t.right[k]
        return t.value[k]
    assert np.allclose(t.margin(x[:50]), [t.prior + sum(walk(r, row) for r in t.roots) for row in x[:50]])
    assert ((t.score(x) > 0.5) == y).mean() > 0.97


def test_statistics_of_odd_texts():
    x = classifier.statistics([t for _, t, *_ in brute.odd_documents()])
    assert x.shape == (len(brute.odd_documents()), len(classifier.FEATURES)) and np.isfinite(x).all()
    assert not x[0].any() and not x[1].any()
    a = classifier.statistics(["one two two", "x\nx\n"])
    column = classifier.FEATURES.index
    assert a[0, column("same_next")] == pytest.approx(1 / 3) and a[1, column("repeated_lines")] == pytest.approx(0.5)


def test_columns_of_any_other_name_stay(spark, odd):
    from basketmine.llm import decontam
    docs = odd
    for name in ("_sh_id", "_sh_key", "_sh_text", "_sh_", "dc_other"):
        docs = docs.withColumn(name, F.lit("clash"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == simhash.keep_one(odd).count()
    assert all(r._sh_id == r._sh_key == r.dc_other == "clash" for r in kept.collect())
    found = decontam.find_occurrences(docs, spark.createDataFrame([(1, "no such text")], "item_id long, text string"))
    assert {"dc_other", "_sh_key"} <= set(found.columns) and found.where("dc_other = 'clash'").count() == docs.count()


def test_every_label_row_of_a_document_trains(spark):
    vectors = spark.createDataFrame([(k, [float(k % 7)] * len(classifier.FEATURES)) for k in range(60)], "doc_id long, x array<float>")
    labels = [(k, int(k % 7 > 3)) for k in range(60)]
    twice = spark.createDataFrame(labels * 2, "doc_id long, quality int")
    a, b = (classifier.train(vectors, df, F.lit(False)) for df in (twice, twice.repartition(5)))
    x = np.array([[float(v)] * len(classifier.FEATURES) for v in range(7)], np.float32)
    assert np.array_equal(a.score(x), b.score(x)) and a.score(x)[0] < 0.5 < a.score(x)[6]
    assert a.prior == pytest.approx(classifier.train(vectors, spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(False)).prior)
