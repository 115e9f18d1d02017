"""Substring deduplication by fixed-block anchors.

Each document is cut into non-overlapping blocks of ``BLOCK`` words, its anchors.  Any
``WINDOW``-word passage of a document holds one of its anchors whole, because
``WINDOW >= 2 * BLOCK - 1``.  Every rolling block of every document probes the anchors
(round 1); a probe that meets another document's anchor is extended by all windows
around it, which are compared exactly by hash (round 2), and the windows that an
earlier document also holds merge into maximal repeats.

Chunks are ranges of doc_id, so "occurs in a smaller doc_id" is "occurs in a
smaller chunk, or in a smaller doc_id of the same chunk", and a reply is one bit per
hash.  Both rounds go through :mod:`.exchange`: one entry per distinct hash and chunk.

Defined cases: null or empty texts and texts under ``WINDOW`` words lose nothing; rows with a
null doc_id come after all others and never remove words elsewhere; rows with the
same doc_id do not remove each other's words; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE_SPLIT, mix64
from .exchange import answer, ask, ask_with, parts_of, settle, slot_cuts, slot_of, text_hashes

WINDOW = 13
BLOCK = 7
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPREAD = np.uint64(0xA0761D6478BD642F)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes (also across texts; callers leave those out)."""
    n = max(0, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= _BASE
        out += h[j:j + n]
    return mix64(out)


class _Chunk:
    """Rolling hashes of the documents of one chunk that have at least one window."""

    def __init__(self, pdf: pd.DataFrame, parts: int):
        self.parts = parts
        h, self.words = text_hashes(pdf["text"], SPACE_SPLIT)
        ids = pdf["doc_id"].astype("Int64")
        rank = np.full(len(pdf), len(pdf), np.int64)
        known = ids.notna().to_numpy()
        rank[known] = np.unique(ids[known].to_numpy(np.int64), return_inverse=True)[1]
        first = np.cumsum(self.words) - self.words
        doc = np.repeat(np.arange(len(pdf)), self.words)
        at = np.arange(len(h)) - first[doc]
        self.gram = rolling(h, BLOCK)
        n = len(self.gram)
        inside = at[:n] + BLOCK <= self.words[doc[:n]]
        self.at = np.flatnonzero(inside & (self.words[doc[:n]] >= WINDOW))   # positions of rolling blocks
        self.gram = self.gram[self.at]
        self.doc, self.rank = doc, rank
        self.anchor = (at[self.at] % BLOCK == 0) & known[doc[self.at]]
        self.hashes, self.first = h, first
        self.n = len(h)

    def probes(self):
        """Distinct probe hashes, whether each is an anchor here, and the entry of each rolling block."""
        keys, entry = np.unique(self.gram, return_inverse=True)
        anchor = np.zeros(len(keys), bool)
        anchor[entry[self.anchor]] = True
        return keys, anchor, entry

    def local(self, keys, anchor, entry):
        """Entries whose anchor is met by a block of another document of this chunk."""
        low = np.full(len(keys), 1 << 60)
        high = np.full(len(keys), -1)
        d = self.doc[self.at]
        np.minimum.at(low, entry, d)
        np.maximum.at(high, entry, d)
        return anchor & (low != high)

    def windows(self, shared: np.ndarray):
        """Start positions of the windows around the shared rolling blocks."""
        near = np.zeros(self.n + WINDOW, bool)
        hit = self.at[shared]
        for back in range(WINDOW - BLOCK + 1):
            near[np.maximum(hit - back, 0)] = True
        p = np.flatnonzero(near[:self.n])
        p = p[p - self.first[self.doc[p]] + WINDOW <= self.words[self.doc[p]]]
        whole = np.zeros(len(p), np.uint64)
        for j in range(WINDOW):
            whole *= _BASE
            whole += self.hashes[p + j]
        return p, mix64(whole * _SPREAD)


def _send(keys: np.ndarray, parts: int, payload):
    cuts = slot_cuts(slot_of(keys, parts), parts)
    return [(s, payload(cuts[s], cuts[s + 1])) for s in range(parts) if cuts[s] < cuts[s + 1]]


def _bits(keys: np.ndarray, parts: int, replies: dict, number: int) -> np.ndarray:
    """The replied bit of every key, in order."""
    cuts = slot_cuts(slot_of(keys, parts), parts)
    out = np.zeros(len(keys), bool)
    for s in range(parts):
        n = cuts[s + 1] - cuts[s]
        if n:
            out[cuts[s]:cuts[s + 1]] = np.unpackbits(np.frombuffer(replies[number, s][0], np.uint8), count=n).astype(bool)
    return out


def _anchor_question(parts: int):
    def question(pdf, _):
        keys, anchor, _ = _Chunk(pdf, parts).probes()
        # within a slot 32 more bits tell blocks apart well enough: a clash only adds windows to round 2
        short = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return _send(keys, parts, lambda a, b: [short[a:b].tobytes(), np.packbits(anchor[a:b]).tobytes()])
    return question


def _anchor_reply(chunks, payloads):
    """Bit per probe: an anchor of this hash and a block of it lie in different chunks."""
    keys = [np.frombuffer(p[0], np.uint32) for p in payloads]
    every = np.concatenate(keys)
    flags = np.concatenate([np.unpackbits(np.frombuffer(p[1], np.uint8), count=len(k)) for p, k in zip(payloads, keys)])
    chunk = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    _, entry = np.unique(every, return_inverse=True)
    n = int(entry.max()) + 1 if len(entry) else 0
    low, high, anchored = np.full(n, 1 << 30), np.full(n, -1), np.zeros(n, bool)
    np.minimum.at(low, entry, chunk)
    np.maximum.at(high, entry, chunk)
    anchored[entry[flags == 1]] = True
    shared = (anchored & (low != high))[entry]
    cuts = np.cumsum([0] + [len(k) for k in keys])
    return [[np.packbits(shared[a:b]).tobytes()] for a, b in zip(cuts, cuts[1:])]


def _candidates(pdf, replies, parts):
    chunk = _Chunk(pdf, parts)
    keys, anchor, entry = chunk.probes()
    shared = _bits(keys, parts, replies, 1) | chunk.local(keys, anchor, entry)
    at, window = chunk.windows(shared[entry])
    return chunk, at, window


def _window_question(parts: int):
    def question(pdf, replies):
        chunk, at, window = _candidates(pdf, replies, parts)
        owned = np.unique(window[chunk.rank[chunk.doc[at]] < len(pdf)]) if len(at) else window
        keys = np.unique(window)
        own = np.isin(keys, owned)
        return _send(keys, parts, lambda a, b: [keys[a:b].tobytes(), np.packbits(own[a:b]).tobytes()])
    return question


def _window_reply(chunks, payloads):
    """Bit per window: it occurs in a smaller chunk (rows without doc_id do not count)."""
    keys = [np.frombuffer(p[0], np.uint64) for p in payloads]
    every = np.concatenate(keys)
    own = np.concatenate([np.unpackbits(np.frombuffer(p[1], np.uint8), count=len(k)) for p, k in zip(payloads, keys)])
    order = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    _, entry = np.unique(every, return_inverse=True)
    low = np.full(int(entry.max()) + 1 if len(entry) else 0, 1 << 30)
    np.minimum.at(low, entry[own == 1], order[own == 1])
    earlier = low[entry] < order
    cuts = np.cumsum([0] + [len(k) for k in keys])
    return [[np.packbits(earlier[a:b]).tobytes()] for a, b in zip(cuts, cuts[1:])]


def _without(text: str | None, gone: np.ndarray):
    """The text without its removed words (separators stay), and the removed [start, stop) word ranges."""
    if not gone.any():
        return text, []
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate([[False], SPACE_SPLIT[data], [False]])
    word = np.cumsum(inside[1:-1] & ~inside[:-2]) - 1
    keep = ~(SPACE_SPLIT[data] & gone[np.maximum(word, 0)])
    spans = [{"start": int(a), "stop": int(b)} for a, b in zip(edge[0::2], edge[1::2])]
    return data[keep].tobytes().decode("utf-8", "surrogatepass"), spans


def _finish(parts: int, columns: list[str]):
    def finish(pdf, replies):
        if not len(pdf):
            return pd.DataFrame(columns=[*columns, "ss_n_words", "ss_removed", "ss_text"])
        chunk, at, window = _candidates(pdf, replies, parts)
        keys, entry = np.unique(window, return_inverse=True)
        rank = chunk.rank[chunk.doc[at]]
        low = np.full(len(keys), len(pdf) + 1)
        known = rank < len(pdf)
        np.minimum.at(low, entry[known], rank[known])
        repeated = _bits(keys, parts, replies, 2)[entry] | (low[entry] < rank) if len(at) else np.empty(0, bool)
        gone = np.zeros(chunk.n + 1, np.int64)
        np.add.at(gone, at[repeated], 1)
        np.add.at(gone, at[repeated] + WINDOW, -1)
        gone = np.cumsum(gone)[:-1] > 0
        made = [_without(t, gone[a:a + n]) for t, a, n in zip(pdf["text"], chunk.first, chunk.words)]
        out = pdf[columns].copy()
        out["ss_n_words"] = chunk.words
        out["ss_removed"] = [spans for _, spans in made]
        out["ss_text"] = [text for text, _ in made]
        return out
    return finish


def _ranges(docs: DataFrame, parts: int):
    """Chunk number of each row: the range of doc_id it falls into (null: the last), by binary search
    in at most ``parts`` quantiles.  Where the ranges are cut has no influence on the result."""
    bounds = docs.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], max(1000, 4 * parts))).first()[0]
    bounds = sorted(set(bounds or []))
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in range(len(bounds).bit_length(), -1, -1)]
    table = F.lit(bounds)
    found = F.aggregate(F.lit(steps), F.lit(0), lambda at, s: F.when(
        (at + s <= len(bounds)) & (F.get(table, at + s - 1) < F.col("doc_id")), at + s).otherwise(at))
    return F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(found)


def remove_repeats(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``docs`` (any columns, among them an integer ``doc_id`` and ``text``) with ``ss_n_words``, ``ss_removed``
    (word ranges that a window shared with a smaller doc_id covers) and ``ss_text`` (the text without those words).
    Input columns of those names, and ``_chunk``, are replaced."""
    columns = [c for c in docs.columns if c not in ("ss_n_words", "ss_removed", "ss_text", "_chunk")]
    parts = parts_of(docs, parts)
    chunks = docs.select(*columns).withColumn("_chunk", _ranges(docs, parts).cast("int"))
    schema = T.StructType([docs.schema[c] for c in columns] + [
        T.StructField("ss_n_words", T.LongType()),
        T.StructField("ss_removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
        T.StructField("ss_text", T.StringType())])
    met = answer(ask(chunks, _anchor_question(parts), 1), _anchor_reply)
    earlier = answer(ask_with(chunks, met, _window_question(parts), 2), _window_reply)
    return settle(chunks, met.unionByName(earlier), _finish(parts, columns), schema)


def q_substring(spark, sf_dir: str) -> DataFrame:
    from .common import table
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("ss_removed", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    kept = F.btrim(F.regexp_replace(F.coalesce("ss_text", F.lit("")), r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    return done.select("doc_id", F.col("ss_n_words").alias("n_words"), removed.alias("n_removed"),
                       F.sha2(kept, 256).alias("kept_sha256"))
