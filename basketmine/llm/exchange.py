"""Ask-and-answer rounds between chunks of documents and slots of a hash space.

Documents are dealt to chunks once.  In a round each chunk sends every slot one
sorted, duplicate-free array of the hashes it holds there, and gets back a value
per entry in the same order.  A hash that occurs in a third of all documents is
one entry per chunk, so no slot has a hot key, and what is sent is a few bytes
per distinct hash and chunk.  The chunk exchange is the same plan in every round
of a query, so Spark shuffles the texts once and reuses it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, word_hashes, word_spans

SCAN_BYTES = 1_000_000
ROUND = "slot int, chunk int, round int, payload array<binary>"


def parts_of(docs: DataFrame, parts: int | None) -> int:
    """Number of chunks and of slots: the session's shuffle partitions unless given."""
    return parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_hashes(texts: Iterable[str | None], classes: np.ndarray, change: Callable | None = None):
    """Hashes of the words of all texts, one after the other, and the number of words of each."""
    texts = list(texts)
    hashes, counts, at = [], [], 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size < SCAN_BYTES):
            size += len(texts[stop] or "")
            stop += 1
        data, offsets = joined_bytes(texts[at:stop])
        if change is not None:
            data = change[data]
        start, end, doc = word_spans(data, offsets, classes)
        hashes.append(word_hashes(data, start, end))
        counts.append(np.bincount(doc, minlength=stop - at))
        at = stop
    return (np.concatenate([np.empty(0, np.uint64), *hashes]),
            np.concatenate([np.empty(0, np.int64), *counts]).astype(np.int64))


def planes(x: np.ndarray) -> bytes:
    """Bytes of an integer array, all low bytes first: small values leave runs of zeros for the shuffle codec."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(dtype).ravel()


def slot_cuts(slots_sorted: np.ndarray, parts: int) -> np.ndarray:
    return np.searchsorted(slots_sorted, np.arange(parts + 1))


def slot_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Slot by the upper bits (monotonous in the hash, so sorted hashes are sorted by slot)."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def ask(chunks: DataFrame, question: Callable, number: int) -> DataFrame:
    """Requests of a round: ``question(pdf, {})`` yields (slot, list of byte strings) of one chunk."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(s, int(key[0]), number, p) for s, p in question(pdf, {})]
        return pd.DataFrame(rows, columns=["slot", "chunk", "round", "payload"])
    return chunks.groupBy("_chunk").applyInPandas(run, ROUND)


def ask_with(chunks: DataFrame, replies: DataFrame, question: Callable, number: int) -> DataFrame:
    """Requests that need earlier replies: ``question(pdf, replies)``, replies by (round, slot)."""
    def run(key: tuple, pdf: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        rows = [(s, int(key[0]), number, p) for s, p in question(pdf, _by_slot(got))] if len(pdf) else []
        return pd.DataFrame(rows, columns=["slot", "chunk", "round", "payload"])
    return _with_replies(chunks, replies, run, ROUND)


def settle(chunks: DataFrame, replies: DataFrame, finish: Callable, schema) -> DataFrame:
    """Result rows of each chunk: ``finish(pdf, replies)`` is a pandas frame of ``schema``."""
    def run(key: tuple, pdf: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        return finish(pdf, _by_slot(got))
    return _with_replies(chunks, replies, run, schema)


def _by_slot(got: pd.DataFrame) -> dict:
    return {(r, s): list(p) for r, s, p in zip(got["round"], got["slot"], got["payload"])}


def _with_replies(chunks, replies, run, schema) -> DataFrame:
    mine = replies.select(F.col("chunk").alias("_chunk"), F.col("slot").alias("slot"), F.col("round").alias("round"),
                          F.col("payload").alias("payload"))
    return chunks.groupBy("_chunk").cogroup(mine.groupBy("_chunk")).applyInPandas(run, schema)


def answer(requests: DataFrame, reply: Callable) -> DataFrame:
    """Replies of a round: ``reply(chunks, payloads)`` returns a list of byte strings for each chunk of one slot."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        out = reply(pdf["chunk"].to_numpy(), [list(p) for p in pdf["payload"]])
        return pd.DataFrame({"slot": pdf["slot"].to_numpy(), "chunk": pdf["chunk"].to_numpy(),
                             "round": pdf["round"].to_numpy(), "payload": out})
    return requests.groupBy("slot").applyInPandas(run, ROUND)
