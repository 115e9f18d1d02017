"""Prefix trie of conversations: who shares which first turns, and what sharing them saves.

A node is a distinct sequence of first turns.  Conversations become sequences of turn codes (128 bits of
a SHA-256 of role and text), which are dealt by range to shards, so that one part of the trie lies in one
shard.  A shard numbers its codes in their order (a dictionary), inserts its distinct sequences into a
ternary search tree, median first so that the tree is balanced, and an iterative traversal adds up
members, leaves and savings from the leaves to the top.  Only nodes on the paths of a shard's first and last
sequence can lie in other shards too.  These boundary nodes are merged for up to ``FAN`` neighbouring shards
at a time, until one group is left: a task never sees more than the paths of 2 x FAN sequences.

Equal sequences are dealt by their id, so a sequence of a third of all rows is spread over shards.  Texts are
read once and never shuffled; a conversation's codes (32 characters a turn) are one row.

Defined results: null role or text is empty; turns are in order of ``turn``, null first, equal ones by their
code; repeated rows are turns of their own; a null id names no conversation and its rows count nowhere; an
empty table has no node; columns that are not asked for are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table

CODE = 32                  # characters of a turn code
FAN = 64                   # neighbouring shards whose boundary nodes are merged in one task
ROOT_KEY = ""              # key of the node without turns
_WORD = "[^\\x20\\x09-\\x0D]+"


class TernaryTree:
    """Ternary search tree over sequences of integers.  Node 0 is the empty sequence; ``equal`` leads to the
    search tree of the symbols that follow a node, ``low`` and ``high`` lead on within it."""

    def __init__(self):
        self.symbol, self.low, self.equal, self.high, self.parent = [-1], [0], [0], [0], [-1]

    def insert(self, sequence) -> int:
        """The node of ``sequence``."""
        symbol, low, equal, high = self.symbol, self.low, self.equal, self.high
        at = 0
        for s in sequence:
            side, owner, node = equal, at, equal[at]
            while node and symbol[node] != s:
                side, owner = (low if s < symbol[node] else high), node
                node = side[node]
            if not node:
                node = side[owner] = len(symbol)
                symbol.append(s)
                for links in (low, equal, high):
                    links.append(0)
                self.parent.append(at)
            at = node
        return at

    def in_order(self) -> Iterator[int]:
        """All nodes in the order of their sequences, a prefix before what it begins."""
        yield 0
        pending = [(self.equal[0], False)]
        while pending:
            node, met = pending.pop()
            if not node:
                continue
            if met:
                yield node
            else:
                pending += [(self.high[node], False), (self.equal[node], False), (node, True), (self.low[node], False)]


def medians_first(n: int) -> Iterator[int]:
    """0..n-1: the middle, then the middles of both halves, and so on."""
    pending = [(0, n)]
    while pending:
        lo, hi = pending.pop()
        if lo < hi:
            middle = (lo + hi) // 2
            yield middle
            pending += [(middle + 1, hi), (lo, middle)]


# rows of all steps: closed nodes, boundary nodes that wait for their neighbours, and where members end
_ROWS = [("kind", pa.string()), ("shard", pa.int64()), ("key", pa.string()), ("parent_key", pa.string()), ("depth", pa.int64()),
         ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("words", pa.int64()), ("is_first", pa.bool_()), ("is_last", pa.bool_())]
_SCHEMA = ("kind string, shard long, key string, parent_key string, depth long, conv_id long, parent_conv_id long, n_convs long, "
           "n_children long, n_leaves long, saved_tokens long, words long, is_first boolean, is_last boolean")
_BATCH = 20_000


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), _ROWS)], [n for n, _ in _ROWS])
    for row in rows:
        held.append(row)
        if len(held) >= _BATCH:
            yield batch()
            held = []
    if held:
        yield batch()


def _child_key(key: str, code: str) -> str:
    return hashlib.sha256((key + code).encode()).hexdigest()[:CODE]


def shard_rows(shard: int, sequences: list[tuple[str, list[int], list[int]]]) -> Iterator[tuple]:
    """Rows of one shard: ``sequences`` holds its distinct (path, words of each turn, ascending ids), in order."""
    turns = [[path[k:k + CODE] for k in range(0, len(path), CODE)] for path, _, _ in sequences]
    codes = sorted({c for t in turns for c in t})
    number = {c: k for k, c in enumerate(codes)}
    words_of = [0] * len(codes)
    for t, (_, words, _) in zip(turns, sequences):
        for c, w in zip(t, words):
            words_of[number[c]] = w
    tree, end = TernaryTree(), [0] * len(sequences)
    for k in medians_first(len(sequences)):
        end[k] = tree.insert([number[c] for c in turns[k]])
    size = len(tree.symbol)
    members, smallest = [0] * size, [None] * size
    for node, (_, _, ids) in zip(end, sequences):
        members[node], smallest[node] = len(ids), ids[0]
    first, last = set(), set()
    for marked, node in ((first, end[0]), (last, end[-1])):
        while node >= 0:
            marked.add(node)
            node = tree.parent[node]
    order = list(tree.in_order())
    key, depth = [ROOT_KEY] * size, [0] * size
    for node in order[1:]:
        up = tree.parent[node]
        key[node], depth[node] = _child_key(key[up], codes[tree.symbol[node]]), depth[up] + 1
    for node, (_, _, ids) in zip(end, sequences):
        for i in ids:
            yield ("end", shard, key[node], None, depth[node], i, *[None] * 8)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for node in reversed(order):
        up = tree.parent[node]
        boundary = node in first or node in last
        words = words_of[tree.symbol[node]] if node else 0
        if not boundary:
            leaves[node] = leaves[node] if children[node] else 1
            saved[node] += (members[node] - 1) * words
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        if node:
            members[up] += members[node]
            if smallest[up] is None or smallest[node] < smallest[up]:
                smallest[up] = smallest[node]
    for node in order:
        up = tree.parent[node]
        words = words_of[tree.symbol[node]] if node else 0
        boundary = node in first or node in last
        known = not boundary and up not in first and up not in last
        yield ("open" if boundary else "node", shard, key[node], key[up] if node else None, depth[node], smallest[node],
               smallest[up] if known else None, members[node], children[node], leaves[node], saved[node], words,
               node in first, node in last)


def _shard(batches):
    from pyspark import TaskContext
    sequences: list[tuple[str, list[int], list[int]]] = []
    for batch in batches:
        for path, words, i in zip(*(batch.column(c).to_pylist() for c in ("path", "words", "conv_id"))):
            if sequences and sequences[-1][0] == path:
                sequences[-1][2].append(i)
            else:
                sequences.append((path, words, [i]))
    if sequences:
        yield from _batches(shard_rows(TaskContext.get().partitionId(), sequences))


def merged_rows(group: int, rows: list[dict], final: bool) -> Iterator[tuple]:
    """The boundary nodes of neighbouring shards as one: closed nodes, and those that reach beyond the group."""
    low, high = min(r["shard"] for r in rows), max(r["shard"] for r in rows)
    found: dict[str, dict] = {}
    for r in rows:
        outer_first = not final and r["is_first"] and r["shard"] == low
        outer_last = not final and r["is_last"] and r["shard"] == high
        node = found.get(r["key"])
        if node is None:
            found[r["key"]] = dict(r, is_first=outer_first, is_last=outer_last)
            continue
        for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            node[c] += r[c]
        node["conv_id"] = min(node["conv_id"], r["conv_id"])
        node["is_first"] |= outer_first
        node["is_last"] |= outer_last
    for node in sorted(found.values(), key=lambda n: -n["depth"]):
        closed = not (node["is_first"] or node["is_last"])
        if closed:
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
            if node["depth"]:
                up = found[node["parent_key"]]
                up["n_children"] += 1
                up["n_leaves"] += node["n_leaves"]
                up["saved_tokens"] += node["saved_tokens"]
        yield ("node" if closed else "open", group, node["key"], node["parent_key"], node["depth"], node["conv_id"], None,
               *[node[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "words", "is_first", "is_last")])


def _merge(final: bool, fan: int):
    def run(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        yield from _batches(merged_rows(rows[0]["shard"] // fan, rows, final))
    return run


def turn_code(role: Column, text: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, CODE)


def turn_sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` from rows (conv_id, turn, role, text): array of (turn, code, words) in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return (turns.where(F.col("conv_id").isNotNull())
            .select("conv_id", F.struct("turn", turn_code(role, text).alias("code"), F.regexp_count(text, F.lit(_WORD)).alias("words")).alias("t"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")))


def prefix_trie(sequences: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of ``sequences`` (conv_id long, turns: array of structs with code and words).

    Nodes: ``key, conv_id`` (smallest member), ``depth, parent_conv_id`` (smallest member of the parent), ``n_convs,
    n_children, n_leaves, saved_tokens``.  Ends: ``key, conv_id``, the node at which each member ends."""
    flat = stored(sequences.select(F.col("conv_id").cast("long").alias("conv_id"), F.array_join(F.col("turns.code"), "").alias("path"),
                                   F.col("turns.words").cast("array<int>").alias("words")))
    order = ["path", "conv_id"]
    rows = stored(flat.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_shard, _SCHEMA))
    closed = [rows.where("kind = 'node'")]
    waiting, shards = rows.where("kind = 'open'"), rows.agg(F.max("shard")).first()[0]
    while shards is not None:
        final = shards < fan
        step = stored(waiting.groupBy(F.expr(f"shard div {fan}")).applyInArrow(_table_merge(final, fan), _SCHEMA))
        closed.append(step.where("kind = 'node'"))
        waiting, shards = step.where("kind = 'open'"), None if final else shards // fan
    nodes, merged = closed[0], None
    for more in closed[1:]:
        nodes, merged = nodes.unionByName(more), more if merged is None else merged.unionByName(more)
    if merged is None:
        return nodes.select(*_NODE), rows.where("kind = 'end'").select("key", "conv_id")
    # parents that are boundary nodes were not known to their children: few nodes, joined back
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    known = nodes.where("parent_conv_id IS NOT NULL OR depth = 0")
    found = nodes.where("parent_conv_id IS NULL AND depth > 0").join(above, "parent_key").withColumn("parent_conv_id", F.col("_above"))
    return known.select(*_NODE).unionByName(found.select(*_NODE)), rows.where("kind = 'end'").select("key", "conv_id")


_NODE = ["key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def _table_merge(final: bool, fan: int):
    run = _merge(final, fan)

    def merge(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches(run(rows.to_batches()))
    return merge


def _digests(batches):
    """SHA-256 of the comma-joined ids of each key; rows come sorted by key and id, and are hashed as they come."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(str(i).encode())
            else:
                state.update(b",%d" % i)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], ["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``.  One digest is one sequential pass by nature: its ids stream through one task."""
    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_digests, "key string, ends_sha256 string")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation with its first h turns replaced by those of the conversation c - c % 20; h is its checksum modulo 4."""
    own = stored(turn_sequences(conversations))
    heads = own.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    return (own.withColumn("base", F.expr("conv_id - conv_id % 20")).withColumn("h", h).join(heads, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h")),
                                        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(0)))).alias("turns")))


def trie_rows(conversations: DataFrame, fan: int = FAN) -> DataFrame:
    nodes, ends = prefix_trie(rebuilt(conversations), fan)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (nodes.join(ends_digest(ends), "key", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", nothing).alias("ends_sha256")))


def q_trie(spark, sf_dir: str) -> DataFrame:
    return trie_rows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
