"""Token ids in length-delimited binary records with a separate offset index.

A file is a run of frames.  A frame is

    8 bytes   length of the payload (little-endian, as all numbers here)
    4 bytes   masked CRC-32 of these 8 bytes
    payload   1 byte  bytes per id (2 or 4), 4 bytes length of the key (0xFFFFFFFF: null key),
              the key as UTF-8 text, the ids
    4 bytes   masked CRC-32 of the payload
    1 byte    newline

and a checksum c is masked as ((c >> 15) | (c << 17)) + 0xA282EAD8 modulo 2^32, so that a
checksum of data that hold checksums stays sound.  Files are in ascending order of the key
(null first; equal keys by a hash of the text, then by place), within a file and from file
to file.  They are written by Spark's text sink, one frame a row: any file system
that Spark reaches will do, and a task that is lost or repeated leaves no file behind.

The index holds one row per record: file, number, offset and length of the frame, key, number of ids
and ids in earlier records of the file.  With it :func:`read_records` cuts out just the wanted
records, in any order, and :func:`shuffled_records` gives an epoch in a seeded order.

Every task holds one file (about an AQE partition's size), whatever the size of the data; a key on
a third of all rows is dealt over many files, because place in the input breaks its ties.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import stored, table
from .packing import END_TOKEN, vocabulary_path
from .tokens import text_ids

_HEAD, _KEY = struct.Struct("<QI"), struct.Struct("<BI")
_NULL_KEY = 0xFFFFFFFF
FRAME_BYTES = 17           # of a frame besides its payload

INDEX_SCHEMA = "file string, record long, offset long, length long, key string, n_tokens long, before long"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(key: str | None, ids: np.ndarray) -> bytes:
    """A frame without its newline, which the text sink adds."""
    name = b"" if key is None else key.encode("utf-8", "surrogatepass")
    payload = _KEY.pack(ids.itemsize, _NULL_KEY if key is None else len(name)) + name + ids.tobytes()
    head = struct.pack("<Q", len(payload))
    return b"".join([head, struct.pack("<I", masked_crc(head)), payload, struct.pack("<I", masked_crc(payload))])


def _size_at(data, at: int, name: str) -> int:
    """Payload length of the frame at ``at``, by its own checksum."""
    if at + 12 > len(data):
        raise ValueError(f"{name}: cut off within a frame at byte {at}")
    size, crc = _HEAD.unpack_from(data, at)
    if masked_crc(bytes(data[at:at + 8])) != crc or at + size + FRAME_BYTES > len(data):
        raise ValueError(f"{name}: no whole frame at byte {at}")
    return size


def payload_key(data, at: int) -> tuple[str | None, int, int]:
    """Key of the payload at ``at``, bytes per id, and where its ids start."""
    width, size = _KEY.unpack_from(data, at)
    if size == _NULL_KEY:
        return None, width, at + _KEY.size
    return bytes(data[at + 5:at + 5 + size]).decode("utf-8", "surrogatepass"), width, at + 5 + size


def read_frame(data, at: int, name: str = "") -> tuple[str | None, np.ndarray, int]:
    """Key and ids of the frame at ``at`` and where the next one starts; a damaged frame raises ValueError."""
    size = _size_at(data, at, name)
    payload = bytes(data[at + 12:at + 12 + size])
    if struct.unpack_from("<I", data, at + 12 + size)[0] != masked_crc(payload):
        raise ValueError(f"{name}: damaged payload at byte {at}")
    key, width, start = payload_key(payload, 0)
    return key, np.frombuffer(payload, f"<u{width}", offset=start), at + size + FRAME_BYTES


def _framed(vocabulary: str | None, end_token: int):
    def run(batches):
        encoder = text_ids(vocabulary or vocabulary_path())
        end = np.array([end_token], encoder.type)
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            frames = []
            size = 0
            for key, ids in zip(keys, encoder.encode(texts)):
                frames.append(frame(key, np.concatenate([ids, end])))
                size += len(frames[-1])
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])
                    frames, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])
    return run


def write_records(docs: DataFrame, path: str, key: str = "doc_id", vocabulary: str | None = None,
                  end_token: int = END_TOKEN) -> None:
    """Write the ids of every whole ``text``, closed by ``end_token``, as records in ascending order of ``key``.

    One range shuffle of the texts; a null or empty text is one end token, a null key comes first,
    repeated rows are written each, an empty table gives no record; other columns are not read.  The
    input's partitions must come out alike when computed again (a file scan or a stored table does)."""
    rows = docs.select(F.col(key).alias("_order"), F.col(key).cast("string").alias("key"), "text",
                       F.xxhash64("text").alias("_tie"), F.monotonically_increasing_id().alias("_place"))
    # a float key has no exact text; everything else orders by its own type and reads back from its text
    order = [F.col("_order").asc_nulls_first(), "_tie", "_place"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    ranged.mapInArrow(_framed(vocabulary, end_token), "value binary") \
        .select(F.col("value").cast("string").alias("value")).write.option("compression", "none").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``file, content``: the record files below ``path``, one row each."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select(F.col("path").alias("file"), "content"))


def _walk(batches):
    for batch in batches:
        for name, content in zip(batch.column("file").to_pylist(), batch.column("content")):
            data = content.as_buffer()
            at = before = number = 0
            rows = []
            view = memoryview(data) if data is not None else b""
            while at < len(view):
                size = _size_at(view, at, name)
                key, width, start = payload_key(view, at + 12)
                n = (at + 12 + size - start) // width
                rows.append((name, number, at, size + FRAME_BYTES, key, n, before))
                at, before, number = at + size + FRAME_BYTES, before + n, number + 1
                if len(rows) >= 50_000:
                    yield _index_batch(rows)
                    rows = []
            if rows:
                yield _index_batch(rows)


_INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
_INDEX_NAMES = ["file", "record", "offset", "length", "key", "n_tokens", "before"]


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_TYPES)], _INDEX_NAMES)


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index of the records below ``path`` (``INDEX_SCHEMA``), by a walk over the frames' lengths."""
    return _files(spark, path).mapInArrow(_walk, INDEX_SCHEMA)


def with_start(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids of all records before.  Files are numbered in key order by
    their writer; the running sum is over one row per file."""
    number = [F.regexp_extract("file", r"part-(\d+)", 1).cast("long"), F.regexp_extract("file", r"c(\d+)[^/]*$", 1).cast("long")]
    # the largest of (before + n_tokens) is a file's total
    totals = index.groupBy("file").agg(F.max(F.col("before") + F.col("n_tokens")).alias("_total"))
    earlier = F.sum("_total").over(Window.orderBy(*number).rowsBetween(Window.unboundedPreceding, -1))
    return (index.join(totals.select("file", F.coalesce(earlier, F.lit(0)).alias("_earlier")), "file")
            .withColumn("start", F.col("_earlier") + F.col("before")).drop("_earlier"))


def _frames(view, name: str, wanted: list[dict] | None):
    """``(record, key, ids)`` of the wanted frames of a file, or of all."""
    if wanted is not None:
        for w in sorted(wanted, key=lambda w: w["offset"]):
            yield (w["record"], *read_frame(view, w["offset"], name)[:2])
        return
    at = number = 0
    while at < len(view):
        key, ids, at = read_frame(view, at, name)
        yield number, key, ids
        number += 1


def _cut(batches):
    for batch in batches:
        some = batch.column("wanted").to_pylist() if "wanted" in batch.schema.names else [None] * batch.num_rows
        for name, content, wanted in zip(batch.column("file").to_pylist(), batch.column("content"), some):
            rows, size = [], 0
            for number, key, ids in _frames(memoryview(content.as_buffer()), name, wanted):
                rows.append((name, number, key, ids.astype("<u4").tobytes()))
                size += 4 * len(ids)
                if size > 4_000_000:
                    yield _record_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _record_batch(rows)


def _record_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        zip(*rows), [pa.string(), pa.int64(), pa.string(), pa.binary()])], ["file", "record", "key", "ids"])


def read_records(spark: SparkSession, path: str, index: DataFrame | None = None) -> DataFrame:
    """``file, record, key, ids`` (little-endian unsigned 32-bit) of the records that ``index`` lists (any rows of
    it), or of all.  Each file is read once, without a shuffle of its content when all records are
    wanted, and every payload that is read is checked; a damaged one fails the job."""
    files = _files(spark, path)
    if index is not None:
        wanted = index.groupBy("file").agg(F.collect_list(F.struct("record", "offset")).alias("wanted"))
        files = files.join(wanted, "file").select("file", "content", "wanted")
    return files.mapInArrow(_cut, "file string, record long, key string, ids binary")


def shuffled_records(spark: SparkSession, path: str, index: DataFrame | None = None, seed: int = 1) -> DataFrame:
    """The records that ``index`` lists, or all, in an order that depends on ``seed`` and a record's
    place alone, not on the folder."""
    name = F.element_at(F.split("file", "/"), -1)
    place = F.xxhash64(F.lit(seed), F.regexp_extract(name, r"part-(\d+)", 1), F.regexp_extract(name, r"c(\d+)[^/]*$", 1), "record")
    return (read_records(spark, path, index).withColumn("place", place)
            .repartitionByRange("place").sortWithinPartitions("place", "file", "record"))


def written(docs: DataFrame, **options) -> tuple[str, DataFrame]:
    """Records of ``docs`` in a new folder below ``spark.checkpoint.dir``: the folder, and its stored index."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-records-{uuid.uuid4().hex}"
    write_records(docs, path, **options)
    return path, stored(build_index(spark, path))


def q_records(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path, index = written(docs)
    records = read_records(spark, path).select("file", "record", F.crc32("ids").alias("ids_crc32"))
    return (with_start(index).join(records, ["file", "record"])
            .select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "start", "n_tokens", "ids_crc32"))
