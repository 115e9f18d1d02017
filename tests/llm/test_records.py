from __future__ import annotations

import random
import re
import struct
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from basketmine.llm import records, tokens
from basketmine.llm.packing import vocabulary_path

ODD_TEXTS = ["A.B, c.. d., É, É. <|endoftext|> x", None, "", " ", "a b c d", "é, H̱ H̱, ≠, ≠.", "it's I'll 'd. 12.5, 3,",
             "x\x0by\x0cz.", "日本語, ok. İ İ.", "a.\tb,\r\nc.", ".", ",.", "Z.", " A, b.", "x" * 5000 + "."]


def masked(data):
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17 & 0xFFFFFFFF) + 0xA282EAD8) % 2 ** 32


def parsed(data):
    """Independent reader of one file: (key, ids, offset, length) of every frame."""
    at, found = 0, []
    while at < len(data):
        size, = struct.unpack("<Q", data[at:at + 8])
        assert struct.unpack("<I", data[at + 8:at + 12])[0] == masked(data[at:at + 8])
        payload = data[at + 12:at + 12 + size]
        assert struct.unpack("<I", data[at + 12 + size:at + 16 + size])[0] == masked(payload)
        assert data[at + 16 + size:at + 17 + size] == b"\n"
        width, n = payload[0], struct.unpack("<I", payload[1:5])[0]
        key = None if n == 0xFFFFFFFF else payload[5:5 + n].decode()
        start = 5 if key is None else 5 + n
        found.append((key, list(struct.unpack(f"<{(size - start) // width}{'HI'[width == 4]}", payload[start:])), at, size + 17))
        at += size + 17
    return found


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary_path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_tokenizers_own(name):
    encoder = tokens.TextIds(public_tokenizers.path(name), cache_words=300)
    assert encoder.by_word == (name == "word_bpe_49k.json")
    rng = random.Random(5)
    texts = ODD_TEXTS + [t for _, t, *_ in brute.odd_documents()]
    texts += ["".join(rng.choice("aB.,'s \n\té̱́<|1") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for size in (1, 7, len(texts)):       # the cache overflows and is emptied on the way
        for at in range(0, len(texts), size):
            for text, ids in zip(texts[at:at + size], encoder.encode(texts[at:at + size])):
                assert ids.tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_another_shape_of_tokenizer_encodes_whole_texts():
    encoder = tokens.TextIds(vocabulary_path())
    from tokenizers import normalizers
    encoder.tokenizer.normalizer = normalizers.NFC()
    assert not tokens.splits_at_space(encoder.tokenizer)


@pytest.fixture(scope="module")
def many_files(spark):
    """Small partitions stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def done(odd, many_files):
    path, index = records.written(odd)
    return path, index.cache()


def place(file):
    return int(re.search(r"part-(\d+)", file)[1]), int(re.search(r"c(\d+)[^/]*$", file)[1])


def test_files_hold_every_row_in_key_order(spark, odd, done, reference):
    path, index = done
    files = sorted(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect(), key=lambda r: place(r.path))
    assert len(files) > 1
    found, lines, total = [], [], 0
    for f in files:
        before = 0
        for number, (key, ids, at, length) in enumerate(parsed(bytes(f.content))):
            found.append((key, ids))
            lines.append((f.path, number, at, length, key, len(ids), before, total + before))
            before += len(ids)
        total += before
    want = [(None if d is None else str(d), reference(t)) for d, t, *_ in
            sorted(brute.odd_documents(), key=lambda r: (r[0] is not None, r[0] or 0))]
    assert [k for k, _ in found] == [k for k, _ in want]                       # null first, then ascending
    assert sorted(map(repr, found)) == sorted(map(repr, want))                 # repeated rows each
    got = records.with_start(index).select("file", "record", "offset", "length", "key", "n_tokens", "before", "start").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(lines, key=repr)


def test_reading_all_some_and_shuffled(spark, done):
    path, index = done
    plain = {(r.file, r.record): (r.key, r.ids) for r in records.read_records(spark, path).collect()}
    assert len(plain) == index.count() == len(brute.odd_documents())
    some = index.where("key IN ('5', '6', '10') OR key IS NULL")
    cut = {(r.file, r.record): (r.key, r.ids) for r in records.read_records(spark, path, some).collect()}
    assert len(cut) == 6 and all(plain[k] == v for k, v in cut.items())
    orders = [[(r.file, r.record) for r in records.shuffled_records(spark, path, index, seed).collect()] for seed in (1, 1, 2)]
    assert orders[0] == orders[1] != orders[2] and all(sorted(o) == sorted(plain) for o in orders)
    assert orders[0] != sorted(orders[0])


def test_damage_is_found():
    data = records.frame("7", np.array([1, 2, 3], "<u2")) + b"\n"      # the sink ends every row
    assert records.read_frame(data, 0)[0] == "7" and records.read_frame(data, 0)[1].tolist() == [1, 2, 3]
    for k in range(len(data) - 1):        # the closing newline carries nothing
        broken = bytearray(data)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(bytes(broken), 0)
    for k in range(1, len(data)):
        with pytest.raises(ValueError):
            records.read_frame(data[:k], 0)


def test_text_keys_and_empty_tables(spark, none):
    path, index = records.written(none)
    assert index.count() == records.with_start(index).count() == records.read_records(spark, path).count() == 0
    named = spark.createDataFrame([("b", "x y"), ("a", None), ("ä", "z"), ("", "q")], "name string, text string")
    path, index = records.written(named, key="name", end_token=0)
    assert [r.key for r in records.with_start(index).orderBy("start").collect()] == ["", "a", "b", "ä"]
    assert {r.key: r.ids[-4:] for r in records.read_records(spark, path).collect()}["a"] == b"\0\0\0\0"


def test_one_key_on_most_rows_is_dealt_over_files(spark, many_files):
    rows = spark.range(400).select(F.when(F.col("id") < 300, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("same text").alias("text"))
    _, index = records.written(rows)
    assert index.where("key = '1'").select("file").distinct().count() > 1


def test_query_against_brute_force(spark, reference):
    from samples import SF_SMALL
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, start = [], 0
    for r in rows:
        ids = reference(r.text)
        want.append((r.doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    got = records.q_records(spark, SF_SMALL)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted(map(tuple, got.collect())) == want
