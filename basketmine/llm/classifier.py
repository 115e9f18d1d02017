"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text is turned into a vector of statistics in one pass over the documents
(no shuffle); the small table of vectors is stored.  The trees are fitted with numpy on a
bounded sample of labelled vectors (at most ``TRAIN_ROWS``, chosen by the hash of doc_id), on
feature histograms, and flattened into arrays: one row per node.  Scoring walks all trees
for a batch of vectors at once.

Defined cases: a null or empty text has the statistics zero and is scored like any other;
repeated rows get equal scores; without usable labels the score is 0.5; label rows without
a quality or without a document are ignored; columns besides doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_SPLIT, hash_share, joined_bytes, stored, word_hashes, word_spans
from .substring import rolling

TRAIN_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAF_ROWS = 20
RIDGE = 1.0
SCAN_BYTES = 4_000_000
THRESHOLD = 0.3

_LINE = np.ones(256, bool)
_LINE[0x0A] = False
_CLASSES = {  # share of the bytes of a text
    "symbols": b"#*$%&|<>", "stops": b".,;:?", "marks": b"!", "digits": b"0123456789", "quotes": b"\"'()[]{}",
    "upper": bytes(range(0x41, 0x5B)), "lower": bytes(range(0x61, 0x7B)), "space": b" \t", "lines": b"\n",
    "other": bytes(range(0x80, 0x100))}
FEATURES = [*_CLASSES, "log_words", "word_bytes", "word_spread", "longest_word", "short_words", "distinct_words",
            "top_word", "same_next", "repeated_triples", "repeated_lines", "words_per_line", "one_word_lines", "capital_words"]


def _share(count, n):
    return count / np.maximum(n, 1)


def statistics(texts) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    data, offsets = joined_bytes(texts)
    n = len(offsets) - 1
    size = np.diff(offsets) - 1
    columns = []
    for members in _CLASSES.values():
        flag = np.zeros(256, bool)
        flag[list(members)] = True
        upto = np.concatenate([[0], np.cumsum(flag[data])])
        count = upto[offsets[1:] - 1] - upto[offsets[:-1]]
        columns.append(_share(count, size))
    start, end, doc = word_spans(data, offsets, SPACE_SPLIT)
    length = (end - start).astype(np.float64)
    words = np.bincount(doc, minlength=n)
    mean = _share(np.bincount(doc, length, n), words)
    spread = np.sqrt(np.maximum(_share(np.bincount(doc, length ** 2, n), words) - mean ** 2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    h = word_hashes(data, start, end)

    def distinct(keys, owner):
        """Distinct keys of each text and the count of its most frequent one."""
        order = np.lexsort((keys, owner))
        k, o = keys[order], owner[order]
        head = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (o[1:] != o[:-1]))) if len(k) else np.empty(0, np.int64)
        run = np.diff(np.append(head, len(k)))
        top = np.zeros(n)
        np.maximum.at(top, o[head], run)
        return np.bincount(o[head], minlength=n), top

    different, top = distinct(h, doc)
    same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    triple = rolling(h, 3)
    whole = doc[2:] == doc[:len(triple)]
    triples = np.bincount(doc[:len(triple)][whole], minlength=n)
    different3, _ = distinct(triple[whole], doc[:len(triple)][whole])
    line_start, line_end, line_doc = word_spans(data, offsets, _LINE)
    lines = np.bincount(line_doc, minlength=n)
    different_lines, _ = distinct(word_hashes(data, line_start, line_end), line_doc)
    at = np.searchsorted(start, np.append(line_start, len(data)))
    alone = np.bincount(line_doc, np.diff(at) == 1, n)
    first = data[start] if len(start) else np.empty(0, np.uint8)
    capital = np.bincount(doc, (first >= 0x41) & (first <= 0x5A), n)
    columns += [np.log1p(words), mean, spread, np.log1p(longest), _share(np.bincount(doc, length <= 3, n), words),
                _share(different, words), _share(top, words), _share(np.bincount(doc[1:], same, n) if len(doc) else 0, words),
                1 - _share(different3, triples) * (triples > 0) - (triples == 0), 1 - _share(different_lines, lines) * (lines > 0) - (lines == 0),
                np.log1p(_share(words, lines)), _share(alone, lines), _share(capital, words)]
    return np.stack([np.broadcast_to(c, n) for c in columns], axis=1).astype(np.float32)


def _vectors(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        made, at = [], 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size < SCAN_BYTES):
                size += len(texts[stop] or "")
                stop += 1
            made.append(statistics(texts[at:stop]))
            at = stop
        if made:
            x = np.concatenate(made)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))],
                ["doc_id", "x"])


def document_vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<float>) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_vectors, f"doc_id {kind}, x array<float>")


@dataclass
class Trees:
    """All trees flattened: node k splits on ``feature`` at ``threshold`` (a leaf points to itself)."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 by walking every tree for all rows at once."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            go_left = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(go_left, self.left[node], self.right[node])
        return self.prior + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Gradient boosting of the logistic loss on histograms of ``BINS`` quantile bins; ties between
    splits go to the lowest feature and bin."""
    share = y.mean() if len(y) else 0.5
    prior = float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3))))
    nodes = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def node() -> int:
        k = len(nodes["value"])
        for name, v in (("feature", 0), ("threshold", np.inf), ("left", k), ("right", k), ("value", 0.0)):
            nodes[name].append(v)
        return k

    roots = []
    if len(y) and 0 < share < 1:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
        lane = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1) + np.arange(width) * BINS
        margin = np.full(n, prior)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            root = node()
            roots.append(root)
            work = [(root, np.arange(n), 0)]
            while work:
                k, rows, depth = work.pop()
                total_g, total_h = g[rows].sum(), h[rows].sum()
                weight = -RATE * total_g / (total_h + RIDGE)
                nodes["value"][k] = weight
                if depth < DEPTH and len(rows) >= 2 * LEAF_ROWS:
                    flat = lane[rows].ravel()
                    hist = [np.bincount(flat, np.repeat(v, width), width * BINS).reshape(width, BINS).cumsum(axis=1)
                            for v in (g[rows], h[rows], np.ones(len(rows)))]
                    gl, hl, nl = hist
                    gain = gl ** 2 / (hl + RIDGE) + (total_g - gl) ** 2 / (total_h - hl + RIDGE) - total_g ** 2 / (total_h + RIDGE)
                    gain[(nl < LEAF_ROWS) | (len(rows) - nl < LEAF_ROWS)] = -1
                    f, b = divmod(int(gain.argmax()), BINS)
                    if gain[f, b] > 1e-6 and b < len(edges[f]):
                        below = lane[rows, f] <= f * BINS + b
                        nodes["feature"][k], nodes["threshold"][k], nodes["value"][k] = f, float(edges[f][b]), 0.0
                        nodes["left"][k], nodes["right"][k] = node(), node()
                        work += [(nodes["left"][k], rows[below], depth + 1), (nodes["right"][k], rows[~below], depth + 1)]
                        continue
                margin[rows] += weight
    if not roots:
        roots, prior = [node()], prior if len(y) else 0.0
    return Trees(*(np.array(nodes[k]) for k in ("feature", "threshold", "left", "right", "value")), np.array(roots), prior)


def train(vectors: DataFrame, labels: DataFrame, held_out, rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled vectors that are not held out, chosen by the hash of doc_id.
    The share is set by the number of labels, so each task sends its share of the sample only.
    Every label row counts: a document with several is as many rows of the sample."""
    usable = labels.where(F.col("quality").isin(0, 1)).where(~held_out).select("doc_id", "quality")
    share = 0.95 * rows / max(usable.count(), 1)
    if share < 1:
        usable = usable.where(hash_share("doc_id", share))
    sample = vectors.join(usable, "doc_id").limit(rows).select("doc_id", "x", "quality").collect()
    sample.sort(key=lambda r: (r.doc_id, r.quality, r.x))
    x = np.array([r.x for r in sample], np.float32).reshape(len(sample), len(FEATURES))
    return fit_trees(x, np.array([r.quality for r in sample], np.float64))


def score_vectors(vectors: DataFrame, model: Trees) -> DataFrame:
    """``vectors`` without x, with ``score``."""
    names = [c for c in vectors.columns if c != "x"]

    def run(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float32).reshape(batch.num_rows, len(FEATURES))
            parts = [model.score(x[a:a + 4096]) for a in range(0, len(x), 4096)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(np.concatenate([np.empty(0), *parts]))],
                                             [*names, "score"])
    schema = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in names)
    return vectors.select(*names, "x").mapInArrow(run, f"{schema}, score double")


def q_classifier(spark, sf_dir: str) -> DataFrame:
    from .common import table
    vectors = stored(document_vectors(table(spark, sf_dir, "documents")))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = train(vectors, table(spark, sf_dir, "labels"), held_out)
    scored = score_vectors(vectors, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
