"""Packing of tokenised documents into fixed windows by best-fit decreasing.

Every document is tokenised whole and closed by an end token.  A document longer
than the window is first cut into full windows; the remainders are placed, longest
first, into the open window with the smallest sufficient capacity, which a segment
tree indexed by remaining capacity finds in O(log window).

Each input partition is packed where it lies, in blocks of ``BLOCK_TOKENS`` tokens:
no shuffle, and a task holds one block whatever the size of its partition.  A
block leaves at most a few windows partly filled, so padding is a small share of
the block's windows (under 1 % at the default size; more if partitions are tiny).
"""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import text_ids

WINDOW = 4096
END_TOKEN = 2
BLOCK_TOKENS = 6_000_000
VOCABULARY = "word_bpe_49k.json"


class CapacityTree:
    """Segment tree over remaining capacities; a leaf counts the open windows with that capacity."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, change: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += change
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """Smallest capacity of at least ``need`` that an open window has."""
        node = need + self.size
        if self.count[node]:
            return need
        while node > 1 and (node & 1 or not self.count[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.size:
            node *= 2
            if not self.count[node]:
                node += 1
        return node - self.size


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> tuple[list[tuple[int, int]], int]:
    """(window number, offset) for each length (1..window), and the number of windows.  Ties keep input order."""
    tree, opened, count = CapacityTree(window), {}, 0
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[k]
        room = tree.tightest(need)
        if room is None:
            room, which, count = window, count, count + 1
        else:
            which = opened[room].pop()
            tree.add(room, -1)
        places[k] = (which, window - room)
        if room > need:
            opened.setdefault(room - need, []).append(which)
            tree.add(room - need, 1)
    return places, count


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


_PIECES = [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
           ("sequence_id", pa.int64()), ("offset", pa.int64())]


def _pack_partition(vocabulary: str | None, names: list[str], types: pa.Schema, window: int, block_tokens: int, end_token: int):
    def run(batches):
        from pyspark import TaskContext

        encoder = text_ids(vocabulary or vocabulary_path())
        closing = struct.pack("<I", end_token)
        sequence = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []    # placed pieces: (document row, start, length, ids, document tokens, sequence, offset)
        rest: list[tuple] = []    # remainders of the block
        held = 0

        def emit(pieces):
            columns = list(zip(*pieces))
            arrays = [pa.array([d[k] for d in columns[0]], types.field(c).type) for k, c in enumerate(names)]
            arrays += [pa.array(columns[k + 1], t) for k, (_, t) in enumerate(_PIECES)]
            return pa.RecordBatch.from_arrays(arrays, names + [c for c, _ in _PIECES])

        def close_block():
            nonlocal sequence, rest, held
            places, count = best_fit_decreasing([r[2] for r in rest], window)
            done = [(*r, sequence + which, at) for r, (which, at) in zip(rest, places)]
            sequence, rest, held = sequence + count, [], 0
            return done

        for batch in batches:
            texts = batch.column("text").to_pylist()
            carried = list(zip(*(batch.column(c).to_pylist() for c in names)))
            for doc, found in zip(carried, encoder.encode(texts)):
                ids = found.astype("<u4").tobytes() + closing
                n = len(ids) // 4
                for start in range(0, n - n % window, window):
                    rows.append((doc, start, window, ids[4 * start:4 * (start + window)], n, sequence, 0))
                    sequence += 1
                if n % window:
                    start = n - n % window
                    rest.append((doc, start, n - start, ids[4 * start:], n))
                held += n
                if held >= block_tokens:
                    rows += close_block()
                if len(rows) >= 2000:
                    yield emit(rows)
                    rows = []
        rows += close_block()
        for lo in range(0, len(rows), 2000):
            yield emit(rows[lo:lo + 2000])
    return run


def pack(docs: DataFrame, keep: list[str] = ["doc_id"], vocabulary: str | None = None, window: int = WINDOW,
         block_tokens: int = BLOCK_TOKENS, end_token: int = END_TOKEN) -> DataFrame:
    """One row per piece: the ``keep`` columns of its document, ``start`` and ``length`` in the
    document's ids, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens`` (with the end token),
    ``sequence_id`` and ``offset`` of its place.  ``vocabulary``: path of the tokenizer file on
    the executors (default: the public word BPE).

    A null or empty text is one end token; repeated rows are packed each; an empty
    table gives no sequence; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    carried = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType(carried.fields + [
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    run = _pack_partition(vocabulary, list(keep), to_arrow_schema(carried), window, block_tokens, end_token)
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, schema)


def q_packing(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
