"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two 32-bit segments.  If two fingerprints
differ in at most 3 bits, one segment differs in at most 1.  Each segment is a
table keyed by its value; every fingerprint probes its own key and the keys at
distance 1 (only bits 0 -> 1: of two values one bit apart, one reaches the
other), and the fetched candidates are verified on all 64 bits.

Work is on distinct fingerprints, so exact copies cost one row.  Buckets with
more than ``BUCKET`` fingerprints (a large group of near copies) are cut into
blocks; each pair of blocks is one task that compares bits in numpy and emits a
spanning star per linked set instead of all its pairs, so links grow with the
group and none is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEGMENT_BITS = 32
BUCKET = 64
BLOCK = 1024
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANE = (np.arange(8, dtype=np.int64) * 256)[None, :]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one text (bitwise majority of XXH64 over word shingles; no word: 0)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        line, ends, at = b" ".join(words), [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], 42) for s, e in zip(starts, ends[shingle - 1:])]
    h = np.array(hashes, dtype=np.uint64)
    lanes = np.bincount((h.view(np.uint8).reshape(-1, 8) + _LANE).ravel(), minlength=2048).reshape(8, 256)
    majority = (lanes @ _BITS * 2 > len(h)).astype(np.uint8)
    return int(np.packbits(majority, axis=1, bitorder="little").ravel().view(np.int64)[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _near(a, b):
    return F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS


def _block_links(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links of two blocks of one bucket as stars: every member of a linked set, with its first left member."""
    a, b = left["fp"].to_numpy(), right["fp"].to_numpy()
    near = np.bitwise_count((a[:, None] ^ b[None, :]).view(np.uint64)) <= MAX_BITS
    out_u, out_v = [], []
    fresh_a, fresh_b = np.ones(len(a), bool), np.ones(len(b), bool)
    for k in range(len(a)):
        if not fresh_a[k]:
            continue
        front = np.array([k])
        fresh_a[k] = False
        while len(front):
            cols = np.flatnonzero(near[front].any(0) & fresh_b)
            fresh_b[cols] = False
            rows = np.flatnonzero(near[:, cols].any(1) & fresh_a) if len(cols) else cols
            fresh_a[rows] = False
            front = rows
            members = np.concatenate([b[cols], a[rows]])
            out_u.append(np.full(len(members), a[k]))
            out_v.append(members)
    if not out_u:
        return pd.DataFrame({"u": np.empty(0, np.int64), "v": np.empty(0, np.int64)})
    pairs = pd.DataFrame({"u": np.concatenate(out_u), "v": np.concatenate(out_v)})
    return pairs[pairs.u != pairs.v]


def links(fingerprints: DataFrame) -> DataFrame:
    """(u, v) links of distinct fingerprints ``fp`` that connect everything within ``MAX_BITS`` bits.

    Outside hot buckets each link is a pair within the distance; in hot buckets
    stars stand for the linked sets.
    """
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    high = F.shiftrightunsigned("fp", SEGMENT_BITS)
    index = fingerprints.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), low.alias("key")), F.struct(F.lit(1).alias("seg"), high.alias("key")))).alias("k"))
    index = index.select("fp", "k.seg", "k.key")
    sizes = index.groupBy("seg", "key").agg(F.count("*").alias("n"))
    index = stored(index.join(sizes, ["seg", "key"]))
    flips = F.transform(F.filter(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1)), lambda b:
                                 F.getbit(F.col("key"), b) == 0),
                        lambda b: F.col("key").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)))
    probes = (index.select("fp", "seg", F.explode(flips).alias("key"), F.lit(True).alias("flip"))
              .unionByName(index.select("fp", "seg", "key", F.lit(False).alias("flip"))))

    plain = (probes.alias("a").join(index.where(f"n <= {BUCKET}").alias("b"), ["seg", "key"])
             .where(_near(F.col("a.fp"), F.col("b.fp")) & (F.col("a.flip") | (F.col("a.fp") < F.col("b.fp"))))
             .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))

    hot = index.where(f"n > {BUCKET}")
    hot_left = probes.select("fp", "seg", "key").join(hot.select("seg", "key").distinct(), ["seg", "key"], "left_semi")
    left_sizes = hot_left.groupBy("seg", "key").agg(F.count("*").alias("left_n"))
    blocks = left_sizes.join(hot.select("seg", "key", "n").distinct(), ["seg", "key"]).select(
        "seg", "key", F.ceil(F.col("left_n") / BLOCK).cast("int").alias("rows"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("cols"))
    turn = F.xxhash64("fp")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        out = side.join(blocks, ["seg", "key"])
        out = out.withColumn(own, F.pmod(turn, F.col(own)).cast("int"))
        return out.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))) \
            .select(*[F.col(c).alias(name) for c, name in (("seg", "seg"), ("key", "key"), ("rows", "i"), ("cols", "j"),
                                                            ("fp", "fp"))])  # own attributes for each side

    left = dealt(hot_left, "rows", "cols")
    right = dealt(hot.select("fp", "seg", "key"), "cols", "rows")
    group = ["seg", "key", "i", "j"]
    dense = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(_block_links, "u long, v long")
    return plain.unionByName(dense)


def _classes(marked: DataFrame, first) -> DataFrame:
    """(fp, label, first) of the distinct fingerprints of ``marked``: rows with one ``label``
    form a group, ``first`` is the aggregate over the rows of a fingerprint."""
    distinct = marked.groupBy("fp").agg(first.alias("first"))
    label = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    return stored(distinct.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp")))


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most
    ``MAX_BITS`` bits.  Null and empty texts have fingerprint zero and are linked
    like any other; repeated rows each get a row; other columns are not read.
    """
    marked = stored(docs.select(F.col(doc_id).alias("doc_id"), _fingerprints(F.col(text)).alias("fp")))
    classes = _classes(marked, F.min("doc_id"))
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "label").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group one row with its
    smallest doc_id stays (null is the largest).

    A row is known by doc_id and a digest of its text: equal texts are of one
    group, so rows that share both are of one group too, whatever else shares the doc_id.
    """
    mine = "_sh"
    while any(c.startswith(mine) for c in docs.columns):     # columns of its own, whatever the input's are called
        mine += "_"
    known, key = f"{mine}_id", f"{mine}_key"
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    marked = stored(docs.select(F.col("doc_id").alias("_sh_id"), digest.alias("_sh_text"),
                                _fingerprints(F.col("text")).alias("fp")))
    classes = _classes(marked, F.min(F.struct(F.isnull("_sh_id").alias("none"), "_sh_id", "_sh_text")))
    first = stored(classes.groupBy("label").agg(F.min("first").alias("first")).select("first._sh_id", "first._sh_text"))
    copies = (marked.alias("m").join(first.alias("g"), F.col("m._sh_id").eqNullSafe(F.col("g._sh_id"))
                                     & (F.col("m._sh_text") == F.col("g._sh_text")))
              .groupBy("m._sh_id", "m._sh_text").agg(F.count("*").alias("n")))
    repeated = copies.where("n > 1").limit(1).count() > 0
    chosen = first.select(F.col("_sh_id").alias(known), F.col("_sh_text").alias(f"{mine}_text"))
    kept = docs.withColumn(key, digest).join(chosen, docs["doc_id"].eqNullSafe(F.col(known)) & (F.col(key) == F.col(f"{mine}_text")))
    kept = kept.dropDuplicates(["doc_id", key]) if repeated else kept
    return kept.drop(known, f"{mine}_text", key)


def q_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import table
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
