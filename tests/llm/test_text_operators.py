from __future__ import annotations

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from basketmine.llm import chat, decontam, html_text, licenses, quality

ITEMS = [(1, brute.invented(60, 1)[:200]), (2, "Word"), (3, None), (4, ""), (None, brute.invented(12, 7)),
         (5, " ".join(brute.invented(200, 7).split()[:15])), (6, " ".join(brute.invented(200, 7).split()[5:20])),
         (6, " ".join(brute.invented(200, 7).split()[5:20])), (10, "a a a")]


def by_row(rows, *names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


def test_decontamination_against_brute_force(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(((d, t, *(lambda w, h, i: (w, len(h), i))(*brute.occurrences(t, ITEMS)))
                   for d, t, *_ in brute.odd_documents()), key=repr)
    full = decontam.find_occurrences(odd, items)
    assert set(odd.columns) - {"dc_spans"} <= set(full.columns)
    got = sorted(((r.doc_id, r.text, r.dc_n_words, sum(s.stop - s.start for s in r.dc_spans), r.dc_items)
                  for r in full.collect()), key=repr)
    assert got == want
    assert decontam.find_occurrences(none, items).count() == 0
    clean = decontam.clean_documents(odd, items)
    assert clean.count() == sum(w[3] == 0 for w in want)
    assert all(not r.dc_spans for r in decontam.find_occurrences(odd, items.where("false")).select("dc_spans").collect())


def test_decontamination_in_several_blocks(spark, odd, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = decontam.find_occurrences(odd, items).select("doc_id", "text", "dc_spans", "dc_items").collect()
    blocks = decontam.pattern_blocks
    monkeypatch.setattr(decontam, "pattern_blocks", lambda df: blocks(df, entries=7))
    parts = decontam.find_occurrences(odd, items).select("doc_id", "text", "dc_spans", "dc_items").collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, parts))


def test_wu_manber_tables_find_every_pattern():
    rng = np.random.default_rng(3)
    for m in (1, 2, 3, 10):
        text = rng.integers(0, 4, 3000)
        patterns = np.unique(np.stack([text[a:a + m] for a in rng.integers(0, 2900, 20)] + [np.full(m, 9)]), axis=0)
        doc = np.repeat(np.arange(30), 100)
        at, which = decontam._Tables(patterns, np.arange(len(patterns))).search(text, doc)
        want = {(i, k) for i in range(3000 - m + 1) for k, p in enumerate(patterns)
                if doc[i] == doc[i + m - 1] and (text[i:i + m] == p).all()}
        assert set(zip(at.tolist(), which.tolist())) == want


def test_quality_statistics_and_verdicts(spark, odd, none):
    got = quality.base_statistics(odd)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = sorted(((d, t, *brute.base_statistics(t)) for d, t, *_ in brute.odd_documents()), key=repr)
    assert by_row(got.collect(), "doc_id", "text", *names) == want
    judged = quality.quality_rules(odd).collect()
    assert len(judged) == len(want) and all(r.kept is not None for r in judged)
    assert all(not r.kept for r in judged if r.base_failed)
    assert quality.quality_rules(none).count() == 0


def test_quality_rejects_planted_outliers(spark):
    rows = [(i, brute.invented(150 + i % 50, i), "en", "s", 0) for i in range(200)]
    junk = [(1000 + i, " ".join(w + "###" for w in brute.invented(150, 900 + i).split()), "en", "s", 0) for i in range(20)]
    out = quality.quality_rules(spark.createDataFrame(rows + junk, brute.SCHEMA)).collect()
    assert {r.doc_id for r in out if not r.kept} == {r[0] for r in junk}
    # sources too small for an estimate are judged with the others of their language
    few = spark.createDataFrame([(*r[:3], f"s{r[0] % 30}", 0) for r in rows + junk], brute.SCHEMA)
    assert {r.doc_id for r in quality.quality_rules(few).collect() if not r.kept} == {r[0] for r in junk}
    alone = quality.quality_rules(few.limit(30)).collect()
    assert all(r.kept and r.source in {f"s{k}" for k in range(30)} for r in alone)


def test_quality_rejects_outliers_of_each_statistic_alone(spark):
    rows = [(i, brute.invented(150 + i % 50, i), "en", "s", 0) for i in range(200)]

    def planted(kind, words):
        if kind == "symbols":
            return " ".join(w + "#" * (i < 6) for i, w in enumerate(words))
        if kind == "lines":
            return "\n".join(x for i in range(0, 150, 18) for x in ("ok", " ".join(words[i:i + 18])))
        return " ".join(words + words[:20] if kind == "repeats" else [w + w for w in words])
    kinds = ["symbols", "lines", "repeats", "length"]
    junk = [(1000 + i, planted(kinds[i % 4], brute.invented(150, 900 + i).split()), "en", "s", 0) for i in range(20)]
    for i, r in enumerate(junk):  # each far off in its own statistic only
        _, _, symbols, lines, repeated = brute.base_statistics(r[1])
        assert [symbols > 0, lines > 0, repeated > 6] == [kinds[i % 4] == k for k in kinds[:3]]
    out = quality.quality_rules(spark.createDataFrame(rows + junk, brute.SCHEMA)).collect()
    assert {r.doc_id for r in out if not r.kept} == {r[0] for r in junk} and not any(r.base_failed for r in out)


def quality_vectors(texts):
    """The four features of each text."""
    rows = []
    for t in texts:
        words, (n, chars, symbols, dup, rep) = brute.SPACED.findall(t or ""), brute.base_statistics(t)
        lines = sum(1 for x in (t or "").split("\n") if brute.SPACED.search(x))
        rows.append([np.log(max(chars, 1) / max(n, 1)), np.log((symbols + 0.5) / (n + 1)), np.log((dup + 0.5) / (lines + 1)),
                     np.log((n - len(set(words)) + rep + 1) / (n + 1))])
    return np.array(rows)


def numpy_mcd(x):
    """(n, mean, covariance): exact medians and order statistics, starts and steps as the module says."""
    floor = np.array(list(quality.RESOLUTION.values()))
    centre = np.median(x, 0)
    scale = np.maximum(1.4826 * np.median(np.abs(x - centre), 0), floor)
    bent = np.tanh((x - centre) / scale)
    dev = bent.std(0)
    r = 0.9 * ((bent - bent.mean(0)).T @ (bent - bent.mean(0)) / len(x)) / np.maximum(np.outer(dev, dev), 1e-9)
    np.fill_diagonal(r, 1.0)
    best = (np.inf,)
    for start in (np.diag(scale ** 2), r * np.outer(scale, scale)):
        m, c, was = centre, start, np.inf
        for _ in range(20):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            core = x[np.argsort(d, kind="stable")[:int(np.ceil(0.75 * len(x)))]]
            m, c = core.mean(0), np.cov(core.T, bias=True) + np.diag(floor ** 2)
            det = np.linalg.slogdet(c)[1]
            best = min(best, (det, tuple(m), c.tobytes()), key=lambda b: b[0])
            if det >= was - 1e-3:
                break
            was = det
    m, c = np.array(best[1]), np.frombuffer(best[2]).reshape(4, 4)
    d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    return len(x), m, c * np.median(d) / quality.CHI2_MEDIAN


def test_quality_against_an_independent_mcd(spark):
    """Same verdicts as numpy with sorted distances (the operator cuts at histogram edges), but for distances near the cutoff."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(420):
        words = brute.invented(60 + int(rng.integers(0, 240)), 3000 + k, 300 + 40 * (k % 3)).split()
        step = 9 + int(rng.integers(0, 9))
        lang, source = [("en", "a"), ("en", "b"), ("de", None), (None, "c"), ("en", f"s{k % 9}")][k % 5 if k % 5 < 4 or k % 2 else 0]
        if k % 29 == 0:      # far off in one feature
            words = [w + w for w in words]
        if k % 31 == 0:
            words = [w + "#&" for w in words]
        if k % 37 == 0:      # usual in each feature, unusual together
            words = words[:60] + words[:10]
        rows.append((k, "\n".join(" ".join(words[i:i + step]) for i in range(0, len(words), step)), lang, source, 0))
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, brute.SCHEMA)).collect()}
    x = quality_vectors([r[1] for r in rows])
    passed = np.array([not got[r[0]].base_failed for r in rows])
    shrink = lambda own, prior: (own[0] / (own[0] + quality.PRIOR) * own[k] + quality.PRIOR / (own[0] + quality.PRIOR) * prior[k] for k in (1, 2))
    whole = numpy_mcd(x[passed])
    agree = rejected = 0
    for lang in {r[2] for r in rows}:
        mine = np.array([r[2] == lang for r in rows]) & passed
        tongue = (0, *shrink(numpy_mcd(x[mine]), whole))
        for source in {r[3] for r in rows if r[2] == lang}:
            group = mine & np.array([r[3] == source for r in rows])
            if not group.any():
                continue
            m, c = shrink(numpy_mcd(x[group]), tongue)
            for r, v in zip(np.array(rows, object)[group], x[group]):
                d = (v - m) @ np.linalg.inv(c) @ (v - m)
                near = 0.6 < d / quality.CUTOFF < 1.6
                agree += near or got[r[0]].kept == (d <= quality.CUTOFF)
                rejected += d > quality.CUTOFF
                assert near or got[r[0]].kept == (d <= quality.CUTOFF), (r[0], d, got[r[0]].distance)
    assert rejected > 15 and agree == passed.sum()


def test_quality_replaces_its_own_columns_and_no_other(spark, odd):
    out = quality.quality_rules(odd.withColumn("kept", F.lit("clash")))
    assert dict(out.dtypes)["kept"] == "boolean" and dict(out.dtypes)["n_words"] == "bigint" and dict(out.dtypes)["score"] == "string"
    assert all(r.score == "clash" for r in out.select("score").collect())


def test_quality_uses_no_python(odd):
    plan = quality.base_statistics(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_gate_changes_nothing():
    rng = random.Random(8)
    assert not any(" " in k for r in licenses.rules() for k in r.keywords)
    parts = sorted({w for r in licenses.rules() for w in r.keywords} | set("""gnu general public license licence version v 2 2.0 3 4.0 by nc sa nd
        attribution noncommercial non-commercial share-alike sharealike creative commons apache lesser library affero under the mit spdx
        identifier: or later only mozilla bsd 3-clause document x""".split()))
    gaps = [" ", "\n", "-", "  ", ", ", "\t"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(1, 14)))
        assert licenses.detect(text) == licenses.detect(text, gated=False), text


def test_license_spellings():
    labels = lambda t: {x[-1] for x in licenses.detect(t)}
    assert labels("creative\ncommons attribution 4.0") == {"cc-by-4.0"}
    assert labels("creative-commons attribution-noncommercial 4.0") == {"cc-by-nc-4.0"}
    assert labels("creative commons attribution non-commercial share-alike 3.0") == {"cc-by-nc-sa-3.0"}
    assert labels("gnu library general public license version 2") == {"lgpl-2"}
    assert labels("gnu general public licence version 3") == labels("gnu general\npublic license v3") == {"gpl-3"}


def test_license_base_places_against_brute_force(spark, odd):
    phrases = {("under", "the", "mit", "license"): "mit", ("apache", "license", "version", "2"): "apache-2", ("cc", "by", "nc"): "cc-by-nc"}
    rng = random.Random(9)
    parts = "under the mit license MIT License apache Apache version 2 2.0 CC by BY-NC cc nc x é".split()
    texts = ["".join(rng.choice(parts) + rng.choice([" ", "\n", "-", "...", ", "]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    for r in licenses.scan_licenses(docs).collect():
        words = brute.ALNUM.findall(brute.low(r.text))
        want = sorted((i, label) for p, label in phrases.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p)
        assert sorted((x.first_word, x.label) for x in r.lic_found if x.base) == want and r.lic_n_words == len(words)


def test_licenses(spark, odd, none):
    texts = [(1, "Licensed under the MIT\nLicense. cc-by-nc, and CC BY-NC 4.0; under the mit licensee"), (2, None), (3, "under the mit"),
             (4, "license"), (5, "Apache License, Version 2.0 and SPDX-License-Identifier: Apache-2.0"), (6, "mit license " * 3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    base = {k: sorted((x.label, x.first_word) for x in r.lic_found if x.base) for k, r in rows.items()}
    assert base == {1: [("cc-by-nc", 5), ("cc-by-nc", 9), ("mit", 1)], 2: [], 3: [], 4: [], 5: [("apache-2", 0)], 6: []}
    assert rows[2].lic_n_words == 0 and rows[6].lic_n_words == 6000 and len([x for x in rows[6].lic_found]) == 3000
    assert {x.label for x in rows[5].lic_found} == {"apache-2", "apache-2.0"}
    assert len(licenses.rules()) > 200
    assert licenses.scan_licenses(odd).count() == len(brute.odd_documents()) and licenses.scan_licenses(none).count() == 0


def test_license_suppression_by_containment():
    hits = [(0, 50, 2, .5, "long"), (5, 20, 4, .9, "inner high"), (6, 18, 1, .1, "inner low"), (0, 50, 2, .5, "same"), (40, 60, 1, .2, "overlap")]
    assert [h[4] for h in licenses.resolve(hits)] == ["long", "inner high", "overlap"]


def test_chat_round_trip(spark):
    rng = random.Random(5)
    roles = ["system", "user", "assistant", None, "tool\n<s>", ""]
    rows = [(c, t, "system" if t == 0 and (c or 0) % 3 == 0 else rng.choice(roles), rng.choice(
        [None, "", "</s>[INST] &amp; &lt;s> <s>", brute.invented(rng.randint(1, 400), t * 31 + (c or 0)), "line\nline \\n"]))
        for c in [1, 2, 3, 9, None] for t in range(rng.choice([1, 2, 40]))]
    rows += [(4, None, "user", "no turn"), (4, 0, "user", "twice"), (4, 0, "user", "twice"), (4, 0, "assistant", "tie"),
             (5, 0, "assistant", brute.invented(9000, 8))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, window string")
    windows = chat.read_turns(chat.chat_windows(df, budget=700, history_tokens=150)).collect()
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        mine = sorted((w for w in windows if w.conv_id == conv), key=lambda w: w.first)
        assert [(t.role, t.text) for w in mine for t in w.own] == [(r, x) for _, r, x in turns]
        assert [x for w in mine for x in w.targets] == [x for _, r, x in turns if r == "assistant"]
        assert sum(w.n_own for w in mine) == mine[0].n_turns == len(turns)
        for w in mine:
            assert w.text.count("<s>") == w.text.count("</s>") == w.n_own + w.n_repeated and "[" not in w.text
            assert w.n_own == 1 or sum(len(p) / 4 for p in w.text.split("</s>")) <= 760
            if w.first and turns[0][1] == "system":
                assert w.text.startswith("<s>system\n")
    assert any(w.n_repeated > 1 for w in windows)
    assert chat.chat_windows(df.where("false")).count() == 0
    plan = chat.read_turns(chat.chat_windows(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_windows(turns, budget, history_turns, history_tokens, size):
    """(first, own turns, repeated turns, starts with the system turn) of each window of ``turns(role, text, tokens)``."""
    starts = [sum(n for _, _, n in turns[:k]) for k in range(len(turns))]
    system = turns[0][0] == "system"
    room = budget - history_tokens - (turns[0][2] if system else 0)
    firsts = []
    for k, a in enumerate(starts):
        if not firsts or a // size != starts[firsts[-1]] // size or a + turns[k][2] - starts[firsts[-1]] > room:
            firsts.append(k)
    out = []
    for f, stop in zip(firsts, [*firsts[1:], len(turns)]):
        history = max([h for h in range(1, history_turns + 1) if f - h >= system and starts[f] - starts[f - h] <= history_tokens], default=0)
        out.append((f, stop - f, history + (system and f > 0), system and f > 0))
    return out


def test_chat_windows_of_a_hot_conversation(spark):
    """A third of all rows in one conversation and in the null id: spread over tasks, same windows as turn by turn."""
    rng = random.Random(11)
    rows = []
    for c, n in [(1, 900), (None, 900), *((k, rng.randint(1, 40)) for k in range(2, 40))]:
        for t in range(n):
            role = "system" if t == 0 and (c is None or c % 2) else rng.choice(["user", "assistant"])
            rows.append((c, t, role, f"{c} {t} " + "x" * rng.randint(0, 30), 3000 if rng.random() < .005 else rng.randint(0, 60)))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, counts long").repartition(7)
    sizes = dict(budget=300, history_turns=3, history_tokens=90)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_hot_windows(df, rows, sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def check_hot_windows(df, rows, sizes):
    got = chat.chat_windows(df, tokens="counts", block_windows=2, **sizes).collect()
    for conv in {r[0] for r in rows}:
        turns = [(r, x, max(n, 1)) for c, _, r, x, n in rows if c == conv]
        mine = sorted((w for w in got if w.conv_id == conv), key=lambda w: w.first)
        want = brute_windows(turns, size=600, **sizes)
        assert [(w.first, w.n_own, w.n_repeated) for w in mine] == [w[:3] for w in want]
        for w, (first, own, repeated, system) in zip(mine, want):
            told = [turns[0]] * system + turns[first - repeated + system:first + own]
            assert w.text == "".join(f"<s>{r}\n{x}</s>" for r, x, _ in told) and w.n_turns == len(turns)
    flat = df.select("conv_id", "turn", "role", "text")
    sums = chat.prefix_sums(flat, F.lit(1).cast("long"))
    assert sorted((r.conv_id or 0, r.i, r.a) for r in sums.collect() if r.conv_id in (1, None)) == [
        (c, k, k) for c in (0, 1) for k in range(900)]
    assert flat.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "false"


def test_chat_query_against_brute_force(spark):
    from samples import SF_SMALL
    tricky = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want[conv] = (len(turns), brute.sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), brute.sha(loss))
    got = chat.q_chat(spark, SF_SMALL)
    assert "Python" not in got._jdf.queryExecution().toString() and "ExistingRDD" not in got._jdf.queryExecution().toString()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got.collect()} == want and -7 in want


def test_chat_budget_holds_for_a_column_of_counts_and_the_estimate(spark):
    rng = random.Random(6)
    texts = [brute.invented(60, 5), "日本語の文章です。" * 30, "1234567890 " * 30, "<<[[&&" * 30, "a b c d " * 40]
    rows = [(c, t, "assistant", rng.choice(texts)) for c in range(4) for t in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    counted = df.withColumn("counts", F.octet_length(chat.escape(F.col("text"))) + 20)
    for w in chat.chat_windows(counted, budget=3000, history_tokens=500, tokens="counts").collect():
        assert w.n_own == 1 or len(w.text.encode()) <= 3000       # bytes bound the tokens of any byte-level vocabulary
    size = {r.text: r.n for r in df.select("text", chat.token_estimate(F.col("role"), F.col("text")).alias("n")).distinct().collect()}
    from tokenizers import Tokenizer
    from basketmine.llm.packing import vocabulary_path
    tokenizer = Tokenizer.from_file(vocabulary_path())
    for t in texts[1:]:
        assert size[t] >= len(tokenizer.encode(t, add_special_tokens=False).ids)


PAGE = ('<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a</a>'
        "<li><a>b</a></ul></nav><div class=ad>Buy now.</div><article><h1>{h}</h1>{p}</article><footer>&copy; x</footer></body></html>")


def test_html_extraction(spark):
    def page(k):
        body = [brute.invented(40, 10 * k + i).capitalize() + "." for i in range(4)]
        return PAGE.format(h=f"Title &amp; {k}", p="".join(f"<p><b>{x}<br>" for x in body)), "\n".join([f"Title & {k}", *body])
    made = [page(k) for k in range(30)]
    rows = [(k, "u", html, "clash") for k, (html, _) in enumerate(made)] + [
        (None, None, None, None), (40, "u", "", "clash"), (41, "u", "plain < text & more", "clash"), (42, "u", "<p " * 5000, "clash"),
        (43, "u", "<div>" * 3000 + "deep", "clash"),
        (44, "u", made[0][0].replace("</article>", '<section class="comments"><p>I like this a lot, thank you. It is long.</p></section>'
                                     '<aside>Side</aside><p>End&#x21;</article>'), "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    potentials = html_text.train(df)
    got = {r.page_id: r.main_text for r in html_text.extract(df, potentials).collect()}
    assert {k: got[k] for k in range(30)} == {k: text for k, (_, text) in enumerate(made)}
    assert got[None] == got[40] == "" and got[44] == made[0][1] + "\nEnd!"
    none = df.where("false")
    assert html_text.extract(none, html_text.train(none)).count() == 0


def test_marginals_equal_enumeration():
    page = html_text.Page("<body><nav><p>Menu one.</p></nav><article><p>Some words of text. <p>More.</article>x</body>")
    counts = np.zeros(html_text.COUNTS, np.int64)
    html_text.count_page(page, counts)
    p = html_text.Potentials(counts)
    f, n = html_text.node_features(page), len(page.parent)
    weight = np.zeros((n, 2))
    for code in range(1 << n):
        x = [code >> k & 1 for k in range(n)]
        w = sum(p.node[j][f[k, j], x[k]] for k in range(n) for j in range(len(html_text.FEATURES))) - 5.0 * x[0]
        w += sum(p.edge[page.own[k], x[page.parent[k]], x[k]] for k in range(1, n))
        for k in range(n):
            weight[k, x[k]] += np.exp(w)
    assert np.allclose(html_text.marginals([page, page], p), np.tile(weight[:, 1] / weight.sum(1), 2))


def test_html_deep_nesting_is_linear():
    import time
    potentials = html_text.Potentials(np.ones(html_text.COUNTS))
    for tags in ("<div>", "<span>", "<div></b></i>", "<p><span>", "<li><span></em>"):
        started = time.process_time()
        page = html_text.Page(tags * 100_000 + "deep")
        if tags == "<div>":
            assert len(html_text.marginals([page], potentials)) == 100_001
        assert time.process_time() - started < 30


def test_html_propagation_carries_pages_without_structural_names(spark):
    """Pages whose tags and attributes tell nothing of their parts give the same text by the other features and the messages."""
    import re
    from basketmine.llm.common import table
    from samples import SF_SMALL
    pages = table(spark, SF_SMALL, "pages")
    potentials = html_text.train(pages)

    def bare(html):
        html = re.sub(r"<(/?)(article|main|nav|header|footer|aside|section)\b", r"<\1div", html or "", flags=re.I)
        return re.sub(r'\s(?:class|id|role)=("[^"]*"|[^\s>]*)', "", html, flags=re.I)
    same = total = 0
    for r in pages.select("html").collect():
        texts = []
        for html in (r.html, bare(r.html)):
            page = html_text.Page(html)
            texts.append(html_text.page_text(page, html_text.marginals([page], potentials) >= 0.5))
            told = html_text.CONTENT in page.own      # the label of a training page
        total += 1
        same += texts[0] == texts[1]
    assert not told and total and same >= 0.95 * total, (same, total)
