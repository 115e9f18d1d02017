"""Merkle manifest of a table: one leaf per row, a tree per group, a tree over the groups' roots.

H is the lowercase hex SHA-256 of its inputs written one after the other, digests as hex text.  Within a
group the leaves stand in the order of a key; while several nodes remain, every two neighbours become
their H (a last one alone becomes its own H).  The groups' roots, ordered by group, become the root in the
same way.

Built levels are stored as parent-linked node rows.  A row links a node to its ancestor ``stride`` levels
up and holds the siblings that are met on the way, so that the recursive query that climbs from every
leaf takes one join per ``stride`` levels instead of one per level (``stride=1`` links each node to its parent).
Each step appends the siblings to the leaf's proof and folds them into its (claimed) digest.

How it runs: rows are ranked by a range shuffle and a running count over one row per group and
partition; a level block of 2^stride neighbours is one small aggregate; the number of aggregates is the
height over the stride.  A group on most rows is dealt like any other, because blocks, not groups, are
the unit.  Nothing but the root (32 bytes) reaches the driver.

Nulls: a null field counts as ``-``; a null key comes before all others, a null group is a group of its own,
before all others.  Rows with equal keys stand in the order of their leaves; repeated rows are a leaf
each.  An empty table has no root and gives no row.  Columns that are not asked for are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

STRIDE = 10
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
_TOP = -1                  # number of the tree over the groups' roots; the others have theirs from 0 on


def digest(*parts: Column) -> Column:
    """32-byte SHA-256 of the parts' text."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: dict[str, Column] | None = None) -> Column:
    """Leaf of a document row; ``columns`` may replace some of its fields."""
    return digest(*[field((columns or {}).get(c, F.col(c))) for c in LEAF_COLUMNS])


def _pair(left: Column, right: Column) -> Column:
    """H of a run; either may be null (absent)."""
    return digest(F.coalesce(hex_text(left), F.lit("")), F.coalesce(hex_text(right), F.lit("")))


def _above(level: Column) -> Column:
    """The level over ``level``, whose nodes are an array."""
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1)), lambda i: _pair(F.get(level, 2 * i), F.get(level, 2 * i + 1)))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``mk_tree`` (a number per group, ascending with it), ``mk_n`` (rows of the group) and
    ``mk_pos`` (from 0 on in ``order``), stored once.  No group meets in one task."""
    by = [F.col(c).asc_nulls_first() for c in [group, *order]]
    put = stored(rows.withColumn("mk_place", F.monotonically_increasing_id())
                 .repartitionByRange(*by, F.col("mk_place")).sortWithinPartitions(*by, "mk_place")
                 .withColumn("mk_row", F.monotonically_increasing_id()).drop("mk_place"))
    put = put.withColumn("mk_part", F.shiftright("mk_row", 33))
    runs = put.groupBy(F.col(group).alias("mk_group"), F.col("mk_part").alias("mk_in")).agg(
        F.min("mk_row").alias("mk_first"), F.count(F.lit(1)).alias("mk_rows"))
    whole = Window.partitionBy("mk_group")
    earlier = F.sum("mk_rows").over(whole.orderBy("mk_in").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("mk_group", "mk_in", (F.coalesce(earlier, F.lit(0)) - F.col("mk_first")).alias("mk_shift"),
                       F.min("mk_first").over(whole).alias("mk_tree"), F.sum("mk_rows").over(whole).alias("mk_n"))
    return (put.join(runs, (put["mk_part"] == runs["mk_in"]) & put[group].eqNullSafe(runs["mk_group"]))
            .withColumn("mk_pos", F.col("mk_row") + F.col("mk_shift")).drop("mk_row", "mk_part", "mk_in", "mk_group", "mk_shift"))


def _blocks(base: DataFrame, carried: list[str], stride: int) -> DataFrame:
    """One row per tree and block of 2^stride neighbours: their paths through the block, and its top node.

    ``base``: mk_tree, mk_n, mk_pos, mk_hash and the carried columns."""
    nodes = F.array_sort(F.collect_list(F.struct("mk_pos", "mk_hash", *carried)))      # places are distinct
    # levels of the tree from here on, and of the block
    height = F.when(F.col("mk_n") > 1, F.length(F.bin(F.col("mk_n") - 1))).otherwise(0)
    out = (base.groupBy("mk_tree", "mk_n", F.shiftright("mk_pos", stride).alias("mk_block")).agg(nodes.alias("mk_nodes"))
           .withColumn("mk_height", F.least(height, F.lit(stride)).cast("int"))
           .withColumn("mk_0", F.transform("mk_nodes", lambda x: x["mk_hash"])))
    for k in range(stride):
        out = out.withColumn(f"mk_{k + 1}", F.when(F.col("mk_height") > k, _above(F.col(f"mk_{k}"))))

    def path(x, i):
        sibling = [F.get(F.col(f"mk_{k}"), F.shiftright(i, k).bitwiseXOR(F.lit(1))) for k in range(stride)]
        return F.struct(x["mk_pos"].alias("mk_pos"), x["mk_hash"].alias("mk_hash"),
                        F.slice(F.array(*sibling), F.lit(1), F.col("mk_height")).alias("mk_siblings"),
                        *[x[c].alias(c) for c in carried])

    top = F.coalesce(*[F.get(F.col(f"mk_{k}"), F.lit(0)) for k in range(stride, -1, -1)])
    return out.select("mk_tree", "mk_n", "mk_block", F.transform("mk_nodes", path).alias("mk_paths"), top.alias("mk_top"))


@dataclass
class Manifest:
    """``leaves``: the carried columns, mk_tree, mk_pos, mk_hash, mk_siblings and the link of every leaf.  ``nodes``: the
    same of the inner rows (mk_tree, mk_base, mk_pos; link: mk_up_tree, mk_up_base, mk_up_pos, null above the
    root).  ``roots``: group, mk_tree and the group's root.  ``root``: 32 bytes, None for an empty table."""
    leaves: DataFrame
    nodes: DataFrame
    roots: DataFrame
    root: bytes | None


def _linked(blocks: DataFrame, base: int, stride: int, top_pos: DataFrame | None) -> DataFrame:
    """Path rows of the blocks with the link to their block's top node: the same tree's next base, or
    for the last block of a group's tree the group's place in the top tree."""
    more = F.col("mk_n") > (1 << stride)
    rows = blocks.select("mk_tree", "mk_n", "mk_block", F.inline("mk_paths"))
    if top_pos is None:
        up = (F.when(more, F.lit(_TOP)), F.when(more, F.lit(base + 1)), F.when(more, F.col("mk_block")))
    else:
        rows = rows.join(top_pos, "mk_tree")
        up = (F.when(more, F.col("mk_tree")).otherwise(F.lit(_TOP)), F.when(more, F.lit(base + 1)).otherwise(F.lit(0)),
              F.when(more, F.col("mk_block")).otherwise(F.col("mk_top_pos")))
    return (rows.withColumn("mk_base", F.lit(base))
            .withColumn("mk_up_tree", up[0].cast("long")).withColumn("mk_up_base", up[1].cast("int")).withColumn("mk_up_pos", up[2].cast("long"))
            .drop("mk_n", "mk_block", "mk_top_pos"))


def _levels(base: DataFrame, carried: list[str], stride: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored blocks of each base level of all trees, and ``mk_tree, mk_hash`` of the trees' roots."""
    levels, roots = [], None
    while True:
        blocks = stored(_blocks(base, carried, stride))
        levels.append(blocks)
        done = blocks.where(F.col("mk_n") <= 1 << stride).select("mk_tree", F.col("mk_top").alias("mk_hash"))
        roots = done if roots is None else roots.unionByName(done)
        base = blocks.where(F.col("mk_n") > 1 << stride).select(
            "mk_tree", F.shiftright(F.col("mk_n") + ((1 << stride) - 1), stride).alias("mk_n"),
            F.col("mk_block").alias("mk_pos"), F.col("mk_top").alias("mk_hash"))
        carried = []
        if base.isEmpty():
            return levels, roots


def build(rows: DataFrame, group: str, order: str, leaf: str, carry: list[str], stride: int = STRIDE) -> Manifest:
    """The manifest of ``rows``: a leaf digest (32 bytes, column ``leaf``) per row, a tree per ``group``, leaves in
    ascending order of ``order`` and then of the digest.  ``carry``: columns that the leaves keep."""
    columns = list(dict.fromkeys([group, order, leaf, *carry]))
    put = placed(rows.select(*columns), group, [order, leaf])
    carried = [c for c in columns if c != leaf]
    levels, roots = _levels(put.select("mk_tree", "mk_n", "mk_pos", F.col(leaf).alias("mk_hash"), *carried), carried, stride)
    names = put.where("mk_pos = 0").select("mk_tree", F.col(group))
    roots = stored(roots.join(names, "mk_tree"))
    top = placed(roots.select("mk_tree", "mk_hash").withColumnRenamed("mk_tree", "mk_of").withColumn("mk_one", F.lit(0)), "mk_one", ["mk_of"])
    top_levels, top_root = _levels(top.select(F.lit(_TOP).cast("long").alias("mk_tree"), "mk_n", "mk_pos", "mk_hash"), [], stride)
    top_pos = top.select(F.col("mk_of").alias("mk_tree"), F.col("mk_pos").alias("mk_top_pos"))
    leaves = _linked(levels[0], 0, stride, top_pos)
    nodes = [_linked(b, k, stride, top_pos) for k, b in enumerate(levels) if k] + [_linked(b, k, stride, None) for k, b in enumerate(top_levels)]
    whole = nodes[0]
    for more in nodes[1:]:
        whole = whole.unionByName(more)
    root = top_root.first()
    return Manifest(leaves, stored(whole), roots, bytes(root["mk_hash"]) if root else None)


_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT mk_id, mk_up_tree, mk_up_base, mk_up_pos, {fold_leaf} AS mk_folded, {prove_leaf} AS mk_proof FROM {{leaves}} n
  UNION ALL
  SELECT c.mk_id, n.mk_up_tree, n.mk_up_base, n.mk_up_pos, {fold_node}, {prove_node}
  FROM climb c JOIN {{nodes}} n ON n.mk_tree = c.mk_up_tree AND n.mk_base = c.mk_up_base AND n.mk_pos = c.mk_up_pos
)
SELECT mk_id, mk_folded, mk_proof FROM climb WHERE mk_up_tree IS NULL"""


def _fold(start: str) -> str:
    """SQL of the digest that the siblings make of ``start``; the bits of the place tell left from right."""
    side = "coalesce(lower(hex(x)), '')"
    return (f"aggregate(n.mk_siblings, named_struct('h', {start}, 'p', n.mk_pos), (s, x) -> named_struct("
            f"'h', unhex(sha2(CASE WHEN s.p & 1 = 1 THEN concat({side}, lower(hex(s.h))) ELSE concat(lower(hex(s.h)), {side}) END, 256)), "
            "'p', shiftright(s.p, 1)), s -> s.h)")


def _prove(start: str) -> str:
    return f"aggregate(n.mk_siblings, {start}, (a, x) -> concat(a, coalesce(x, X'')))"


_CLIMB = _CLIMB.format(fold_leaf=_fold("n.mk_claimed"), prove_leaf=_prove("X''"), fold_node=_fold("c.mk_folded"), prove_node=_prove("c.mk_proof"))


def climb(manifest: Manifest, claimed: str | None = None) -> DataFrame:
    """The leaves with ``mk_proof`` (32-byte siblings, level by level up to the root) and ``mk_folded``: the root
    that the proof makes of the column ``claimed`` (default: of the leaf itself).  One recursive query, stored."""
    leaves = stored(manifest.leaves.withColumn("mk_id", F.monotonically_increasing_id()))
    spark = leaves.sparkSession
    start = leaves.select("mk_id", "mk_pos", "mk_siblings", "mk_up_tree", "mk_up_base", "mk_up_pos",
                          F.col(claimed or "mk_hash").alias("mk_claimed"))
    limit = "spark.sql.cteRecursionRowLimit"       # a guard against endless recursion; this one ends at the root
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        ended = stored(spark.sql(_CLIMB, leaves=start, nodes=manifest.nodes))
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
    return leaves.drop("mk_siblings", "mk_up_tree", "mk_up_base", "mk_up_pos", "mk_base").join(ended, "mk_id").drop("mk_id")


def q_merkle(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*LEAF_COLUMNS)
    return manifest_rows(docs)


def manifest_rows(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """The contract's rows: every seventh document by checksum claims one character more than it has."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    more = F.when(F.coalesce(checksum % 7 == 0, F.lit(False)), F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    rows = stored(docs.select("doc_id", "lang", leaf_digest().alias("leaf"), leaf_digest({"n_chars": more}).alias("claimed")))
    made = build(rows, "lang", "doc_id", "leaf", ["doc_id", "claimed"], stride)
    root = F.lit(None if made.root is None else made.root.hex()).cast("string")
    roots = made.roots.select("mk_tree", hex_text(F.col("mk_hash")).alias("subroot"))
    return climb(made, "claimed").join(roots, "mk_tree").select(
        "doc_id", hex_text(F.col("mk_hash")).alias("leaf"), "subroot", root.alias("root"),
        F.sha2(hex_text(F.col("mk_proof")), 256).alias("proof_sha256"), hex_text(F.col("mk_folded")).alias("folded_root"),
        (hex_text(F.col("mk_folded")) == root).alias("verified"))
