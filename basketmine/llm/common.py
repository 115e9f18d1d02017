"""Helpers shared by the training-data operators: table access, shared scratch
tables and numpy word scanning over the UTF-8 bytes of a batch of texts."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

TABLE_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# byte classes of the two word definitions; bytes of multi-byte characters are word bytes in both
SPACE_SPLIT = np.ones(256, bool)
SPACE_SPLIT[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the folder named by ``spark.checkpoint.dir``
    and return a reader of it: lineage ends there and any executor can read it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables made by :func:`stored` (through Hadoop, so on any store)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for df in frames:
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(name)
            if "/llm-" in name:
                path.getFileSystem(conf).delete(path, True)


def hash_share(key: str, share: float):
    """Condition that holds for about ``share`` of the distinct values of ``key``, the same ones on every run."""
    return F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < int(share * (1 << 30))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (all arithmetic wraps)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def joined_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """All texts (null: empty) as one byte array, each followed by a newline, and
    the start offset of every text (with the end of the last one appended)."""
    parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    return data, offsets


def word_spans(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray):
    """(start, end, text index) of each word; the newline after each text ends its last word."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = classes[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    doc = np.searchsorted(offsets, start, side="right") - 1
    return start, end, doc


_POWERS = np.empty(0, np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers of the odd multiplier, grown by doubling and kept for the life of the worker."""
    global _POWERS
    if len(_POWERS) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _ODD, np.uint64)]), dtype=np.uint64)
    return _POWERS


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes, equal for equal words anywhere.

    The word is read as a polynomial over its bytes from its last byte on (so that no
    division by the position is needed), by one reduceat over the word bytes, then mixed with its length.
    """
    if not len(start):
        return np.empty(0, np.uint64)
    length = (end - start).astype(np.int64)
    first = np.cumsum(length) - length
    total = int(length.sum())
    inner = np.arange(total, dtype=np.int64) - np.repeat(first, length)
    byte = data[inner + np.repeat(start, length)].astype(np.uint64)
    byte += np.uint64(1)
    byte *= mix64(_powers(int(length.max()) + 1))[inner]
    h = np.add.reduceat(byte, first)
    return mix64(h ^ (length.astype(np.uint64) * _ODD))
