"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Letters are words (``[0-9a-z]`` and all non-ASCII characters after lower-casing
A-Z).  The patterns are the windows of ``WINDOW`` consecutive words of each item
(a shorter item is one window).  Patterns of one length share a shift table over
blocks of two words: a position whose block ends no pattern moves on by the
table's shift; shift zero opens the bucket of patterns with that suffix hash, and
direct comparison, of word numbers and then of bytes, confirms an occurrence.

The texts are scanned where they lie, without a shuffle.  The item set is the
stated query set: it is read in blocks of at most ``BLOCK_ENTRIES`` (window, item)
entries and one block's tables are broadcast at a time, so neither the driver
nor an executor holds more, whatever the number of items.  Between blocks the
texts with their hits so far are stored in the shared checkpoint folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, LOWER, drop_stored, joined_bytes, stored, word_hashes, word_spans

WINDOW = 10
BLOCK_ENTRIES = 200_000
LANE = 256               # words per lane of the lockstep scan
SCAN_BYTES = 4_000_000   # texts are scanned in groups of about this size
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class _Tables:
    """Shift tables and suffix buckets of the patterns of one length."""

    def __init__(self, patterns: np.ndarray, ids: np.ndarray):
        n, m = patterns.shape
        self.m, self.width = m, min(2, m)
        self.bits = max(8, int(4 * n).bit_length())
        self.shift = np.full(1 << self.bits, m - self.width + 1, np.int32)
        for end in range(self.width - 1, m):
            key = self.block(patterns[:, end - 1] if self.width == 2 else None, patterns[:, end])
            np.minimum.at(self.shift, key, m - 1 - end)
        suffix = self.block(patterns[:, m - 2] if self.width == 2 else None, patterns[:, m - 1])
        order = np.argsort(suffix, kind="stable")
        self.patterns, self.ids = patterns[order], ids[order]
        self.first = np.searchsorted(suffix[order], np.arange((1 << self.bits) + 1))

    def block(self, before: np.ndarray | None, last: np.ndarray) -> np.ndarray:
        x = last.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        if before is not None:
            x ^= (before.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, letters: np.ndarray, doc: np.ndarray):
        """(start word, pattern id) of every occurrence that lies in one document."""
        m, n = self.m, len(letters)
        pos = np.arange(0, n, LANE, dtype=np.int64)
        stop = np.minimum(pos + LANE, n)
        pos = np.maximum(pos, m - 1)
        found_at, found = [], []
        while True:
            live = pos < stop
            pos, stop = pos[live], stop[live]
            if not len(pos):
                break
            key = self.block(letters[pos - 1] if self.width == 2 else None, letters[pos])
            step = self.shift[key]
            hit = np.flatnonzero(step == 0)
            if len(hit):
                lo, size = self.first[key[hit]], self.first[key[hit] + 1] - self.first[key[hit]]
                end = np.repeat(pos[hit], size)
                pattern = np.repeat(lo, size) + np.arange(len(end)) - np.repeat(np.cumsum(size) - size, size)
                same = doc[end - m + 1] == doc[end]
                for j in range(m):
                    end, pattern = end[same], pattern[same]
                    same = letters[end - m + 1 + j] == self.patterns[pattern, j]
                end, pattern = end[same], pattern[same]
                found_at.append(end - m + 1)
                found.append(self.ids[pattern])
            pos = pos + np.maximum(step, 1)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)


class PatternBlock:
    """A bounded set of windows with their items, ready to search."""

    def __init__(self, windows: dict[tuple[bytes, ...], set]):
        keys = list(windows)
        vocab = sorted({w for k in keys for w in k})
        data, offsets = np.frombuffer(b"\n".join([*vocab, b""]), np.uint8), np.cumsum([0] + [len(w) + 1 for w in vocab])
        hashes = word_hashes(data, offsets[:-1], offsets[1:] - 1)
        order = np.argsort(hashes)
        self.hashes, self.words = hashes[order], [vocab[i] for i in order]
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pattern words share a 64-bit hash")
        letter = {w: i + 1 for i, w in enumerate(self.words)}
        self.items = [sorted(windows[k]) for k in keys]
        self.lengths = np.array([len(k) for k in keys], np.int64)
        self.tables = []
        for m in sorted(set(self.lengths.tolist())):
            ids = np.flatnonzero(self.lengths == m)
            self.tables.append(_Tables(np.array([[letter[w] for w in keys[i]] for i in ids], np.int64), ids))

    def search(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray):
        """(start word, length, pattern id) of the confirmed occurrences."""
        h = word_hashes(data, start, end)
        near = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        letters = np.where(self.hashes[near] == h, near + 1, 0)
        hits = [t.search(letters, doc) for t in self.tables]
        at, pattern = (np.concatenate(x) for x in zip(*hits))
        size = self.lengths[pattern]
        # direct comparison of the bytes of each word that lies in a hit
        place = np.repeat(at, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        wrong = [w for w in np.unique(place).tolist()
                 if data[start[w]:end[w]].tobytes() != self.words[letters[w] - 1]]
        if wrong:
            bad = np.isin(place, wrong)
            sure = np.bincount(np.repeat(np.arange(len(at)), size), bad, len(at)) == 0
            at, size, pattern = at[sure], size[sure], pattern[sure]
        return at, size, pattern


def pattern_blocks(items: DataFrame, window: int = WINDOW, entries: int = BLOCK_ENTRIES) -> Iterator[PatternBlock]:
    """Blocks of the windows of ``items(item_id, text)``, read row by row; null text: no window."""
    windows: dict[tuple[bytes, ...], set] = {}
    held = 0
    for row in items.select("item_id", "text").toLocalIterator():
        words = _WORD.findall((row.text or "").encode("utf-8", "surrogatepass").lower())
        if not words:
            continue
        for i in range(max(1, len(words) - window + 1)):
            known = windows.setdefault(tuple(words[i:i + window]), set())
            if row.item_id is not None:
                known.add(str(row.item_id))
            held += 1
            if held >= entries:
                yield PatternBlock(windows)
                windows, held = {}, 0
    if windows:
        yield PatternBlock(windows)


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], b)
        else:
            out.append({"start": a, "stop": b})
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _scan(block, names: list[str], prefix: str):
    """mapInArrow function: add one block's hits to those found so far."""
    def groups(texts):
        at, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t) if t else 0
            if size >= SCAN_BYTES:
                yield at, i + 1
                at, size = i + 1, 0
        if at < len(texts):
            yield at, len(texts)

    def run(batches):
        tables = block.value if block is not None else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts, spans, found = [], batch.column(prefix + "spans").to_pylist(), batch.column(prefix + "items").to_pylist()
            for lo, hi in groups(texts):
                data, offsets = joined_bytes(texts[lo:hi])
                data = LOWER[data]
                start, end, doc = word_spans(data, offsets, ALNUM)
                per = np.bincount(doc, minlength=hi - lo)
                counts.extend(per.tolist())
                if tables is None or not len(start):
                    continue
                at, size, pattern = tables.search(data, start, end, doc)
                first = np.cumsum(per) - per
                new: dict[int, tuple[list, set]] = {}
                for a, m, p in zip(at.tolist(), size.tolist(), pattern.tolist()):
                    d = int(doc[a])
                    s, ids = new.setdefault(d, ([], set()))
                    s.append((a - int(first[d]), a - int(first[d]) + m))
                    ids.update(tables.items[p])
                for d, (s, ids) in new.items():
                    spans[lo + d] = _merged(s + [(x["start"], x["stop"]) for x in spans[lo + d]])
                    found[lo + d] = sorted(ids.union(found[lo + d]))
            made = [pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + made,
                                             [*names, prefix + "n_words", prefix + "spans", prefix + "items"])
    return run


def find_occurrences(docs: DataFrame, items: DataFrame, prefix: str = "dc_") -> DataFrame:
    """``docs`` (any columns, among them ``text``) with three more:

    ``dc_n_words``, ``dc_spans`` (merged [start, stop) word ranges inside any occurrence
    of an item window) and ``dc_items`` (ids, as strings, of the items with occurring windows).
    Input columns of those names are replaced.  Null or empty texts have no words; an
    empty item table finds nothing; items without id still hit words; repeated rows
    are each searched.
    """
    names = [c for c in docs.columns if c not in (prefix + "n_words", prefix + "spans", prefix + "items")]
    schema = T.StructType([docs.schema[c] for c in names] + [
        T.StructField(prefix + "n_words", T.LongType()),
        T.StructField(prefix + "spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
        T.StructField(prefix + "items", T.ArrayType(T.StringType()))])
    spark = docs.sparkSession
    now = docs.select(*names, F.array().cast("array<struct<start:bigint,stop:bigint>>").alias(prefix + "spans"),
                      F.array().cast("array<string>").alias(prefix + "items"))
    out, kept = None, None
    for block in pattern_blocks(items):
        if out is not None:  # one block's tables at a time: store what the last one found
            done = stored(out.drop(prefix + "n_words"))
            if kept is not None:
                drop_stored(spark, kept)
            now = kept = done
        out = now.mapInArrow(_scan(spark.sparkContext.broadcast(block), names, prefix), schema)
    return out if out is not None else now.mapInArrow(_scan(None, names, prefix), schema)


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any occurrence of an item window."""
    found = find_occurrences(docs, items)
    return found.where(F.size("dc_spans") == 0).drop("dc_n_words", "dc_spans", "dc_items")


def q_decontam(spark, sf_dir: str) -> DataFrame:
    from .common import table
    found = find_occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("dc_spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select("doc_id", F.col("dc_n_words").alias("n_words"), hit.alias("n_hit"),
                        F.size("dc_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("dc_items", ","), 256).alias("items_sha256"),
                        (F.size("dc_spans") > 0).alias("contaminated"))
