"""Language-model scoring: a Katz backoff model over words.

Bigram counts are discounted by Good-Turing; the mass taken from a context is given
to the words not seen after it, in proportion to their unigram probability, so that
the weights normalise exactly.  Unigrams are discounted the same way; what they free
goes to one unknown type.  P(w | u) is evaluated recursively: the discounted bigram if
it was seen, else the context's backoff weight times the (discounted) unigram, else
the unknown type.

The count tables are partitioned over the slots of :mod:`.exchange`: words by their
hash, bigrams by the hash of their context, except that a context with more tokens than
an average slot is spread over all slots by the whole bigram and its sums are added up.
Each chunk of documents sends a slot its distinct n-grams with their training counts
once; counting and answering happen in the same round, and a frequent n-gram is one
entry per chunk.  Words are identified by 64-bit hashes, a successor within its
context by 48 bits.

Defined cases: a null or empty text is one end token; repeated rows count each; with
no training text every probability is that of the unknown type.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE_SPLIT, mix64
from .exchange import (ROUND, answer, ask, ask_with, from_planes, parts_of, planes, settle, slot_cuts, slot_of,
                       text_hashes)

CUT = 5  # counts above it are not discounted
START, END = np.uint64(0x53A1F0C2D4B69781), np.uint64(0x1E7D3B5C9A2F4861)
_U, _V = np.uint64(0x9FB21C651E98DF25), np.uint64(0xE7037ED1A0B428DB)
_LOW48 = np.uint64((1 << 48) - 1)


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing factor of the counts 0..CUT+1 (0 and above CUT: 1) from n[r], the number of types
    with count r (r = 1..CUT+1 at positions 0..CUT).  A factor outside (0, 1] is not used."""
    d = np.ones(CUT + 2)
    if n[0] <= 0:
        return d
    tail = (CUT + 1) * n[CUT] / n[0]
    for r in range(1, CUT + 1):
        if n[r - 1] > 0 and tail < 1:
            x = ((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail)
            if 0 < x <= 1:
                d[r] = x
    return d


def count_classes(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, CUT + 2).astype(np.int64), minlength=CUT + 3)[1:CUT + 2]


class Unigrams:
    """Discounted unigram probabilities from N, V and the counts of counts."""

    def __init__(self, stats: np.ndarray):
        self.tokens, self.types = int(stats[0]), int(stats[1])
        n = stats[2:2 + CUT + 1]
        self.d = discounts(n)
        kept = self.tokens - sum((1 - self.d[r]) * r * n[r - 1] for r in range(1, CUT + 1))
        self.total = float(self.tokens)
        if self.total - kept < 1e-9:  # nothing was discounted: one more token stands for the unknown type
            self.total += 1
        self.unknown = (self.total - kept) / self.total

    def probability(self, counts: np.ndarray) -> np.ndarray:
        c = counts.astype(np.float64)
        return np.where(counts > 0, c * self.d[np.minimum(counts, CUT + 1).astype(np.int64)] / self.total, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts.astype(np.float64) + 1) / (self.tokens + self.types + 1))


def context_weights(total: np.ndarray, kept: np.ndarray, seen: np.ndarray):
    """(denominator, backoff weight) of contexts with ``total`` training tokens, ``kept`` discounted
    counts and ``seen`` unigram mass of their successors."""
    denominator = total.astype(np.float64)
    denominator = np.where(denominator - kept < 1e-9 * np.maximum(denominator, 1), denominator + 1, denominator)
    return denominator, (denominator - kept) / denominator / np.maximum(1 - seen, 1e-300)


def _numbered(keys: np.ndarray):
    """Sorted distinct keys and the place of each key among them, in 32 bits and with few temporaries."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(head, dtype=np.int32) - 1
    return ranked[head], place


class _Chunk:
    """The token sequence of a chunk of documents: entries into its distinct words."""

    def __init__(self, pdf: pd.DataFrame, parts: int):
        self.parts = parts
        h, words = text_hashes(pdf["text"], SPACE_SPLIT, LOWER)
        self.n_tokens = words + 1
        last = np.cumsum(self.n_tokens) - 1
        token = np.empty(int(self.n_tokens.sum()), np.uint64)
        is_end = np.zeros(len(token), bool)
        is_end[last] = True
        token[is_end], token[~is_end] = END, h
        del h, is_end
        self.doc = np.repeat(np.arange(len(pdf), dtype=np.int32), self.n_tokens)
        self.train = ~pdf["held_out"].to_numpy(bool)
        self.learned = self.train[self.doc]
        self.first = last - self.n_tokens + 1
        self.words, self.entry = _numbered(token)
        self.trained = np.bincount(self.entry[self.learned], minlength=len(self.words))

    def unigram_requests(self):
        cuts = slot_cuts(slot_of(self.words, self.parts), self.parts)
        return [(s, [self.words[a:b].tobytes(), planes(self.trained[a:b].astype(np.uint64))])
                for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]

    def learn_counts(self, replies: dict):
        cuts = slot_cuts(slot_of(self.words, self.parts), self.parts)
        self.counts = np.zeros(len(self.words), np.int64)
        for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                self.counts[a:b] = from_planes(replies[1, s][0], np.uint64)
        self.unigrams = Unigrams(np.frombuffer(replies[1, -1][0], np.int64)) if (1, -1) in replies else None

    def pair_up(self):
        """The distinct bigrams: entries of context (START comes after all words) and successor, their
        training counts, and the bigram of each token; for each slot, the bigrams it is asked for, in
        order of context.  Contexts without training are asked for nowhere."""
        n = len(self.words)
        context = np.empty(len(self.entry), np.int64)
        context[1:] = self.entry[:-1]
        context[self.first] = n
        context *= n + 1
        context += self.entry
        keys, self.which = _numbered(context)
        del context
        self.u, self.w = (keys // (n + 1)).astype(np.int32), (keys % (n + 1)).astype(np.int32)
        del keys
        self.pair_trained = np.bincount(self.which[self.learned], minlength=len(self.u)).astype(np.int32)
        self.context_hash = np.append(self.words, START)
        self.context_total = np.append(self.counts, self.counts[np.searchsorted(self.words, END)] if n else 0)
        self.context_hot = self.context_total * self.parts > self.unigrams.tokens
        spot = np.where(self.context_hot[self.u], mix64(self.words[self.w] * _V), np.uint64(0))
        spot ^= self.context_hash[self.u] * _U
        slot = np.where(self.context_total[self.u] > 0, slot_of(mix64(spot), self.parts), self.parts).astype(np.int32)
        del spot
        order = np.argsort(slot, kind="stable").astype(np.int32)
        cuts = slot_cuts(slot[order], self.parts)
        self.asked = [(s, order[a:b]) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]

    def run_starts(self, o: np.ndarray) -> np.ndarray:
        """Whether each of a slot's bigrams begins the run of a new context."""
        return np.append(True, self.u[o][1:] != self.u[o][:-1])

    def bigram_requests(self):
        self.pair_up()
        for s, o in self.asked:
            head = np.flatnonzero(self.run_starts(o))
            u, w = self.u[o][head], self.w[o]
            short = (self.words[w] & _LOW48).view(np.uint8).reshape(-1, 8)[:, :6]
            yield s, [self.context_hash[u].tobytes(), planes(np.diff(np.append(head, len(o))).astype(np.uint64)),
                      planes(self.context_total[u].astype(np.uint64)), np.packbits(self.context_hot[u]).tobytes(),
                      np.ascontiguousarray(short).tobytes(), planes(self.pair_trained[o].astype(np.uint64)),
                      planes(self.counts[w].astype(np.uint64))]


def _sum_words(chunks, payloads):
    keys = [np.frombuffer(p[0], np.uint64) for p in payloads]
    counts = np.concatenate([from_planes(p[1], np.uint64) for p in payloads]).astype(np.int64)
    distinct, entry = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, entry, counts)
    return keys, entry, total


def _unigram_reply(chunks, payloads):
    keys, entry, total = _sum_words(chunks, payloads)
    cuts = np.cumsum([0] + [len(k) for k in keys])
    return [[planes(total[entry[a:b]].astype(np.uint64))] for a, b in zip(cuts, cuts[1:])]


def _unigram_stats(payloads) -> list[bytes]:
    _, _, total = _sum_words(None, payloads)
    return [np.concatenate([[total.sum(), (total > 0).sum()], count_classes(total)]).astype(np.int64).tobytes()]


class _Slot:
    """All bigrams that the chunks sent to one slot, summed up."""

    def __init__(self, payloads):
        parts = []
        for p in payloads:
            u, run = np.frombuffer(p[0], np.uint64), from_planes(p[1], np.uint64).astype(np.int64)
            total, hot = from_planes(p[2], np.uint64).astype(np.int64), np.unpackbits(np.frombuffer(p[3], np.uint8), count=len(u))
            short = np.zeros((int(run.sum()), 8), np.uint8)
            short[:, :6] = np.frombuffer(p[4], np.uint8).reshape(-1, 6)
            parts.append((np.repeat(u, run), short.view(np.uint64).ravel(), from_planes(p[5], np.uint64).astype(np.int64),
                          from_planes(p[6], np.uint64).astype(np.int64), u, run, total, hot))
        self.runs = [(x[4], x[5]) for x in parts]
        contexts = np.concatenate([x[4] for x in parts])
        self.contexts, spot = np.unique(contexts, return_index=True)
        self.total = np.concatenate([x[6] for x in parts])[spot]
        self.hot = np.concatenate([x[7] for x in parts])[spot] == 1
        u = np.searchsorted(self.contexts, np.concatenate([x[0] for x in parts]))
        w = np.concatenate([x[1] for x in parts])
        order = np.lexsort((w, u))
        fresh = np.append(True, (u[order][1:] != u[order][:-1]) | (w[order][1:] != w[order][:-1]))
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(fresh) - 1
        head = order[fresh]
        self.u, self.c_w, self.w = u[head], np.concatenate([x[3] for x in parts])[head], w[head]
        self.count = np.bincount(self.entry, np.concatenate([x[2] for x in parts]), len(head)).astype(np.int64)

    def sums(self, unigrams: Unigrams):
        """Per context: types with count 1..CUT, tokens of higher counts, unigram mass of seen successors."""
        n = len(self.contexts)
        seen = self.count > 0
        out = np.zeros((n, CUT + 2))
        for r in range(1, CUT + 1):
            out[:, r - 1] = np.bincount(self.u[self.count == r], minlength=n)
        high = self.count > CUT
        out[:, CUT] = np.bincount(self.u[high], self.count[high], n)
        out[:, CUT + 1] = np.bincount(self.u[seen], unigrams.probability(self.c_w[seen]), n)
        return out

    def weights(self, unigrams: Unigrams, d: np.ndarray, hot_keys: np.ndarray, hot_sums: np.ndarray):
        """(denominator, backoff weight) per context; hot contexts take their sums over all slots."""
        sums = self.sums(unigrams)
        if len(hot_keys) and self.hot.any():
            sums[self.hot] = hot_sums[np.searchsorted(hot_keys, self.contexts[self.hot])]
        kept = sums[:, :CUT] @ (d[1:CUT + 1] * np.arange(1, CUT + 1)) + sums[:, CUT]
        return context_weights(self.total, kept, sums[:, CUT + 1])


def _no_rows(*columns: str) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([], dtype=object) for c in columns})


def _stat_rows(requests: DataFrame, stats, number: int, parts: int, combine, to: str, extra: DataFrame | None = None) -> DataFrame:
    """One row of global statistics for every chunk or slot: ``stats(payloads)`` of each slot, then
    ``combine`` of these (one small row per slot)."""
    def one(payloads, known):
        return pd.DataFrame({"part": [0], "payload": [stats(payloads, known)]})

    schema = "part int, payload array<binary>"
    if extra is None:
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return one([list(p) for p in pdf.sort_values("chunk")["payload"]], None)
        each = requests.groupBy("slot").applyInPandas(run, schema)
    else:
        def run2(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            if not len(pdf):
                return _no_rows("part", "payload")
            return one([list(p) for p in pdf.sort_values("chunk")["payload"]], list(known["payload"].iloc[0]))
        each = requests.groupBy("slot").cogroup(extra.groupBy("slot")).applyInPandas(run2, schema)

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        payload = combine([list(p) for p in pdf["payload"]])
        rows = [(-1, k, number, payload) if to == "chunk" else (k, -1, number, payload) for k in range(parts)]
        return pd.DataFrame(rows, columns=["slot", "chunk", "round", "payload"])
    return each.groupBy("part").applyInPandas(total, ROUND)


def _swap(rows: DataFrame) -> DataFrame:
    """Statistics addressed to chunks, addressed to slots instead (and the other way round)."""
    return rows.select(F.col("chunk").alias("slot"), F.col("slot").alias("chunk"), F.col("round").alias("round"),
                       F.col("payload").alias("payload"))


def _add(payloads: list[list[bytes]]) -> list[bytes]:
    return [np.sum([np.frombuffer(p[0], np.int64) for p in payloads], axis=0).tobytes()]


def _add_bigrams(payloads: list[list[bytes]]) -> list[bytes]:
    """Counts of counts added up, sums of each hot context added up, unigram statistics carried on."""
    classes = np.sum([np.frombuffer(p[0], np.int64) for p in payloads], axis=0)
    keys = np.concatenate([np.frombuffer(p[1], np.uint64) for p in payloads])
    sums = np.concatenate([np.frombuffer(p[2], np.float64).reshape(-1, CUT + 2) for p in payloads])
    distinct, entry = np.unique(keys, return_inverse=True)
    out = np.zeros((len(distinct), CUT + 2))
    np.add.at(out, entry, sums)
    return [classes.tobytes(), distinct.tobytes(), out.tobytes(), payloads[0][3]]


def _bigram_stats(payloads, known) -> list[bytes]:
    slot = _Slot(payloads)
    sums = slot.sums(Unigrams(np.frombuffer(known[0], np.int64)))
    return [count_classes(slot.count).astype(np.int64).tobytes(), slot.contexts[slot.hot].tobytes(), sums[slot.hot].tobytes(), known[0]]


def _bigram_answers(requests: DataFrame, stats: DataFrame) -> DataFrame:
    def run(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return _no_rows("slot", "chunk", "round", "payload")
        pdf = pdf.sort_values("chunk")
        slot = _Slot([list(p) for p in pdf["payload"]])
        classes, hot_keys, hot_sums, uni = list(known["payload"].iloc[0])
        denominator, weight = slot.weights(Unigrams(np.frombuffer(uni, np.int64)), discounts(np.frombuffer(classes, np.int64)),
                                           np.frombuffer(hot_keys, np.uint64), np.frombuffer(hot_sums, np.float64).reshape(-1, CUT + 2))
        raised = denominator > slot.total
        out, at = [], 0
        for u, run_length in slot.runs:
            n = int(run_length.sum())
            count = slot.count[slot.entry[at:at + n]]
            at += n
            place = np.searchsorted(slot.contexts, u)
            # the weight is only of use where an unseen bigram asks for it
            unseen = np.add.reduceat(count == 0, np.cumsum(run_length) - run_length) > 0
            out.append([planes(count.astype(np.uint64)), planes(np.where(unseen, np.log10(weight[place]), 0.0).view(np.uint64)),
                        np.packbits(raised[place]).tobytes()])
        return pd.DataFrame({"slot": pdf["slot"].to_numpy(), "chunk": pdf["chunk"].to_numpy(), "round": 2, "payload": out})
    return requests.groupBy("slot").cogroup(stats.groupBy("slot")).applyInPandas(run, ROUND)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _finish(parts: int):
    def finish(pdf, replies):
        if not len(pdf):
            return _no_rows(*(c.split()[0] for c in SCORES.split(", ")))
        chunk = _Chunk(pdf, parts)
        chunk.learn_counts(replies)
        uni = chunk.unigrams
        n = len(pdf)
        chunk.pair_up()
        d = discounts(np.frombuffer(replies[2, -1][0], np.int64)) if (2, -1) in replies else np.ones(CUT + 2)
        log_p = np.log10(uni.probability(chunk.counts))[chunk.w]  # contexts without training back off with weight one
        for s, o in chunk.asked:
            counts, weights, raised = replies.pop((2, s))
            count = from_planes(counts, np.uint64).astype(np.int64)
            run = np.cumsum(chunk.run_starts(o)) - 1
            weight = from_planes(weights, np.uint64).view(np.float64)[run]
            more = np.unpackbits(np.frombuffer(raised, np.uint8), count=int(run[-1]) + 1)[run]
            discounted = np.maximum(count, 1) * d[np.minimum(count, CUT + 1)]
            total = chunk.context_total[chunk.u[o]] + more
            log_p[o] = np.where(count > 0, np.log10(discounted) - np.log10(np.maximum(total, 1)), weight + log_p[o])
        return pd.DataFrame({
            "doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "n_tokens": chunk.n_tokens,
            "n_known": np.bincount(chunk.doc, (chunk.counts > 0)[chunk.entry], n).astype(np.int64), "train_tokens": uni.tokens,
            "base_score": np.bincount(chunk.doc, uni.base(chunk.counts)[chunk.entry], n),
            "score": np.bincount(chunk.doc, log_p[chunk.which], n)})
    return finish


def _rounds(docs: DataFrame, parts: int):
    """Chunks, word requests and answers, bigram requests and their statistics."""
    # the text too decides on the chunk, so that many rows with one doc_id (or none) spread out
    chunks = docs.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))

    def bigram_question(pdf, replies):
        chunk = _Chunk(pdf, parts)
        chunk.learn_counts(replies)
        return chunk.bigram_requests()

    words = ask(chunks, lambda pdf, _: _Chunk(pdf, parts).unigram_requests(), 1)
    stats = _stat_rows(words, lambda p, _: _unigram_stats(p), 1, parts, _add, "chunk")
    counts = answer(words, _unigram_reply).unionByName(stats)
    pairs = ask_with(chunks, counts, bigram_question, 2)
    pair_stats = _stat_rows(pairs, _bigram_stats, 2, parts, _add_bigrams, "slot", extra=_swap(stats))
    return chunks, words, stats, counts, pairs, pair_stats


def katz_scores(docs: DataFrame, held_out: str = "held_out", parts: int | None = None) -> DataFrame:
    """Score every row of ``docs(doc_id, text, <held_out>)`` under the model trained on the rows that are
    not held out: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).
    A null flag counts as held out; other columns are not read."""
    parts = parts_of(docs, parts)
    docs = docs.select("doc_id", "text", F.coalesce(F.col(held_out), F.lit(True)).alias("held_out"))
    chunks, _, _, counts, pairs, pair_stats = _rounds(docs, parts)
    answers = _bigram_answers(pairs, pair_stats)
    return settle(chunks, counts.unionByName(answers).unionByName(_swap(pair_stats)), _finish(parts), SCORES)


def katz_tables(docs: DataFrame, path: str, held_out: str = "held_out", parts: int | None = None) -> None:
    """Write the model's tables as Parquet below ``path``, partitioned by slot: ``words`` (word, count,
    probability), ``bigrams`` (context, word48, count, discounted) and ``contexts`` (context, total,
    denominator, weight; one row per slot for a context that is spread over slots).  Words are hashes."""
    parts = parts_of(docs, parts)
    docs = docs.select("doc_id", "text", F.coalesce(F.col(held_out), F.lit(True)).alias("held_out"))
    _, words, stats, _, pairs, pair_stats = _rounds(docs, parts)

    def word_rows(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        keys, entry, total = _sum_words(None, [list(p) for p in pdf["payload"]])
        distinct = np.unique(np.concatenate(keys))
        uni = Unigrams(np.frombuffer(list(known["payload"].iloc[0])[0], np.int64))
        seen = total > 0
        return pd.DataFrame({"slot": key[0], "word": distinct[seen].view(np.int64), "count": total[seen],
                             "probability": uni.probability(total[seen])})

    def model(key, pdf, known):
        slot = _Slot([list(p) for p in pdf["payload"]])
        classes, hot_keys, hot_sums, uni = list(known["payload"].iloc[0])
        d = discounts(np.frombuffer(classes, np.int64))
        return slot, d, slot.weights(Unigrams(np.frombuffer(uni, np.int64)), d, np.frombuffer(hot_keys, np.uint64),
                                     np.frombuffer(hot_sums, np.float64).reshape(-1, CUT + 2))

    def bigram_rows(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        slot, d, _ = model(key, pdf, known)
        seen = slot.count > 0
        c = slot.count[seen]
        return pd.DataFrame({"slot": key[0], "context": slot.contexts[slot.u[seen]].view(np.int64), "word48": slot.w[seen].view(np.int64),
                             "count": c, "discounted": c * d[np.minimum(c, CUT + 1)]})

    def context_rows(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        slot, _, (denominator, weight) = model(key, pdf, known)
        return pd.DataFrame({"slot": key[0], "context": slot.contexts.view(np.int64), "total": slot.total,
                             "denominator": denominator, "weight": weight})

    for name, asked, known, rows, schema in (
            ("words", words, _swap(stats), word_rows, "slot int, word long, count long, probability double"),
            ("bigrams", pairs, pair_stats, bigram_rows, "slot int, context long, word48 long, count long, discounted double"),
            ("contexts", pairs, pair_stats, context_rows, "slot int, context long, total long, denominator double, weight double")):
        present = asked.select("slot").distinct()
        known = known.join(present, "slot", "left_semi")
        asked.groupBy("slot").cogroup(known.groupBy("slot")).applyInPandas(rows, schema) \
            .write.partitionBy("slot").parquet(f"{path}/{name}")


def q_katz(spark, sf_dir: str) -> DataFrame:
    from .common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    flag = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    return katz_scores(docs.withColumn("held_out", flag))
