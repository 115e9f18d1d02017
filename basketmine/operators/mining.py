"""Frequent category sets (K10) and association rules (K11) by pattern growth,
globally or per cluster.

The sets are those of MLlib's ``FPGrowth``, whose recursion is followed without its trees: a basket is an
array of the numbers of its frequent items, rarest first, and the conditional base of a
frequent set is what follows the set's last item in each basket that holds it.  A level extends the frequent sets
of one size by the items of their bases and counts the extensions in one aggregate, which needs one row per
task and extension.  So a level costs a pass over the baskets and holds nothing that grows with
them, where a tree per item grows with the number of different baskets and is built and mined in one task."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from basketmine.session import ensure_checkpoint_dir, keep


@dataclass
class ItemsetModel:
    """What a fit found, with the two tables of MLlib's ``FPGrowthModel``."""
    itemsets: DataFrame     # cluster_id (0), items, freq; cached
    n: int
    min_confidence: float

    @property
    def freqItemsets(self) -> DataFrame:
        return self.itemsets.select("items", "freq")

    @property
    def associationRules(self) -> DataFrame:
        sets = self.itemsets.select("cluster_id", F.array_sort("items").alias("items"), F.size("items").alias("size"), "freq")
        sizes = self.itemsets.sparkSession.createDataFrame([(0, self.n)], "cluster_id int, n long")
        return rules_from_itemsets(sets, sizes, self.min_confidence).drop("cluster_id")


def fit_fpgrowth(transactions: DataFrame, min_support: float = 0.2, min_confidence: float = 0.2,
                 num_partitions: int | None = None, items_col: str = "items") -> ItemsetModel:
    """Frequent sets over ``items`` arrays; duplicates inside a transaction are
    removed first.  An itemset is frequent when its
    count is at least ``ceil(min_support * number of transactions)``.  ``num_partitions``:
    spread the transactions over so many partitions."""
    if not (0 <= min_support <= 1 and 0 <= min_confidence <= 1):
        raise ValueError("min_support and min_confidence must lie in [0, 1]")
    rows = transactions.where(F.col(items_col).isNotNull()).select(
        F.lit(0).alias("cluster_id"), F.array_distinct(F.col(items_col)).alias("items"))
    # cached once here: counted, then read for the items and again for their numbers
    tx = keep(rows.repartition(num_partitions) if num_partitions else rows)
    n = tx.count()
    itemsets = grow_itemsets(tx, {0: n}, min_support)
    tx.unpersist()
    return ItemsetModel(itemsets, n, min_confidence)


def frequent_itemsets(model: ItemsetModel) -> DataFrame:
    """``(items sorted, size, freq)``."""
    return model.freqItemsets.select(F.array_sort("items").alias("items"),
                                     F.size("items").alias("size"), F.col("freq").cast("long").alias("freq"))


def association_rules(model: ItemsetModel) -> DataFrame:
    """``(antecedent sorted, consequent, confidence, lift, support)``; one
    consequent item per rule."""
    return model.associationRules.select(F.array_sort("antecedent").alias("antecedent"),
                                         "consequent", "confidence", "lift", "support")


def grow_itemsets(baskets: DataFrame, sizes: dict[int, int], min_support: float) -> DataFrame:
    """``(cluster_id, items, freq)`` of every set that at least ``min_count`` of its cluster's ``sizes`` baskets
    ``(cluster_id, items)`` hold; an item is at most once in a basket.  Cached; one small job per set size.

    The frequent items of a cluster reach the driver: at most its mean basket size / ``min_support``,
    whatever its number of baskets.  Larger sets do not; their tables are joined (broadcast where they are small)."""
    spark = baskets.sparkSession
    kind = baskets.schema["items"].dataType.elementType
    limits = spark.createDataFrame([(c, min_count(min_support, n)) for c, n in sizes.items()], "cluster_id int, min_count long")
    singles = (baskets.select("cluster_id", F.explode("items").alias("item"))
               .groupBy("cluster_id", "item").agg(F.count(F.lit(1)).alias("freq"))
               .join(limits, "cluster_id").where(F.col("freq") >= F.col("min_count"))
               .select("cluster_id", "item", F.hash("item").alias("hash"), "freq", "min_count").collect())
    total: dict = {}
    for r in singles:
        total[r["item"]] = total.get(r["item"], 0) + r["freq"]
    # rarest first: a frequent set ends in common items, so that little follows it
    order = {x: i for i, x in enumerate(sorted(total, key=lambda x: (total[x], str(x))))}
    names = F.array(*[F.lit(x).cast(kind) for x in order]).cast(f"array<{kind.simpleString()}>")
    level = stored(spark.createDataFrame(
        [(i, r["cluster_id"], order[r["item"]], r["freq"], r["min_count"]) for i, r in enumerate(singles)],
        "id long, prefix long, item int, freq long, min_count long")
        .select("id", "prefix", F.col("prefix").cast("int").alias("cluster_id"), "item", "freq", "min_count", F.array(F.get(names, F.col("item"))).alias("items")))
    levels = [level]

    number = item_number({r["item"]: r["hash"] for r in singles}, order, kind.simpleString())
    ranked = keep(baskets.select(F.col("cluster_id").cast("long").alias("prefix"), F.sort_array(
        F.filter(F.transform("items", number), lambda i: i.isNotNull())).alias("rest")).where(F.size("rest") > 1))
    bases, found, size = ranked, len(singles), 1
    while found > size:     # a frequent set of one item more has size + 1 frequent subsets
        # from (prefix, what follows it) to (frequent extension, what follows that); a cluster is the prefix of its single items
        bases = (bases.select("prefix", "rest", F.posexplode("rest").alias("pos", "item"))
                 .where(F.col("pos") + 1 < F.size("rest"))
                 .join(level.select("prefix", "item", "id"), ["prefix", "item"])
                 .select(F.col("id").alias("prefix"), F.slice("rest", F.col("pos") + 2, F.size("rest")).alias("rest")))
        counts = (bases.select("prefix", F.explode("rest").alias("item"))
                  .groupBy("prefix", "item").agg(F.count(F.lit(1)).alias("freq")))
        grown = counts.join(level.select(F.col("id").alias("prefix"), "cluster_id", "min_count", "items"), "prefix").where(F.col("freq") >= F.col("min_count"))
        # the window sees the frequent sets of one size
        level = stored(grown.select((F.row_number().over(Window.orderBy("prefix", "item")) - 1).cast("long").alias("id"), "prefix", "cluster_id", "item",
                                  "freq", "min_count", F.concat("items", F.array(F.get(names, F.col("item")))).alias("items")))
        found, size = level.count(), size + 1
        levels.append(level)
    sets = keep(reduce(DataFrame.unionByName, levels).select("cluster_id", "items", "freq"))
    sets.count()
    ranked.unpersist()
    return sets


def stored(sets: DataFrame) -> DataFrame:
    """A level, written to the shared checkpoint folder and read back.  The plans of the next levels hold it twice:
    with its lineage they would double at each level.  The file tells its size, so a small level is broadcast to the baskets."""
    path = f"{ensure_checkpoint_dir(sets.sparkSession).rstrip('/')}/itemsets-{uuid.uuid4().hex}"
    sets.coalesce(1).write.parquet(path)
    return sets.sparkSession.read.parquet(path)


def item_number(hashes: dict, order: dict, kind: str):
    """Function from an item to its number in ``order`` (NULL for all others), by a table of hash slots."""
    n = max(len(hashes), 1)
    slots: list[list[Column]] = [[] for _ in range(n)]
    for item, h in hashes.items():
        slots[h % n].append(F.struct(F.lit(item).cast(kind).alias("item"), F.lit(order[item]).alias("number")))
    table = F.array(*[F.array(*slot) for slot in slots]).cast(f"array<array<struct<item: {kind}, number: int>>>")
    return lambda x: F.get(F.filter(F.get(table, F.pmod(F.hash(x), F.lit(n))), lambda held: held["item"].eqNullSafe(x)), F.lit(0))["number"]


def stage_by_cluster(members: DataFrame, cluster_col: str = "cluster_id", items_col: str = "items",
                     folder: str | None = None) -> DataFrame:
    """Write ``(cluster_id, items)`` once as parquet partitioned by cluster into
    the shared checkpoint folder and read it back: every per-cluster reader
    then prunes to its own partition, and the written table survives the loss
    of executors (it also cuts the lineage of the assignments)."""
    spark = members.sparkSession
    folder = folder or ensure_checkpoint_dir(spark)
    path = f"{folder.rstrip('/')}/clusters-{uuid.uuid4().hex}"
    (members.select(F.col(cluster_col).alias("cluster_id"), F.col(items_col).alias("items"))
     # rebalance, not repartition: AQE splits a cluster holding a large share
     # of the rows over several writer tasks instead of one
     .hint("rebalance", "cluster_id")
     .write.mode("overwrite").partitionBy("cluster_id").parquet(path))
    return spark.read.parquet(path)


# Baskets of the mined clusters per partition, unless the caller sets the number of partitions.
ROWS_PER_PART = 100_000


def min_count(min_support: float, n: int) -> int:
    """Minimum itemset count of a fit over n transactions, as MLlib's FPGrowth sets it."""
    return math.ceil(min_support * n)


def rules_from_itemsets(itemsets: DataFrame, sizes: DataFrame, min_confidence: float) -> DataFrame:
    """Association rules with one consequent item from per-cluster itemsets
    ``(cluster_id, items sorted, size, freq)`` and cluster sizes
    ``(cluster_id, n)``: confidence = freq(A u C) / freq(A), lift = confidence /
    (freq(C) / n), support = freq(A u C) / n; rules below ``min_confidence``
    are dropped.  Every itemset of size s yields s candidates, one per item."""
    multi = (itemsets.where(F.col("size") >= 2)
             .select("cluster_id", "items", "freq", F.explode("items").alias("cons"))
             .withColumn("antecedent", F.array_remove("items", F.col("cons"))))
    ante = itemsets.select("cluster_id", F.col("items").alias("antecedent"), F.col("freq").alias("freq_a"))
    single = itemsets.where(F.col("size") == 1).select(
        "cluster_id", F.element_at("items", 1).alias("cons"), F.col("freq").alias("freq_c"))
    confidence = F.col("freq").cast("double") / F.col("freq_a").cast("double")
    return (multi.join(ante, ["cluster_id", "antecedent"])
            .join(single, ["cluster_id", "cons"])
            .join(sizes, "cluster_id")                    # one row per cluster
            .withColumn("confidence", confidence)
            .where(F.col("confidence") >= F.lit(float(min_confidence)))
            .select("cluster_id", "antecedent", F.array("cons").alias("consequent"), "confidence",
                    (F.col("confidence") / (F.col("freq_c").cast("double") / F.col("n").cast("double"))).alias("lift"),
                    (F.col("freq").cast("double") / F.col("n").cast("double")).alias("support")))


def mine_clusters(assignments: DataFrame, clusters: list[int], min_support: float = 0.2,
                  min_confidence: float = 0.2, num_partitions: int | None = None,
                  cluster_col: str = "cluster_id", items_col: str = "items",
                  parallelism: int = 8, staged: bool = True,
                  band_ratio: float = 1.5, cached: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Frequent itemsets and rules of every requested cluster, with support
    relative to the cluster's own basket count.  Returns ``(itemsets, rules)``
    with a ``cluster_id`` column; the result equals one ``fit_fpgrowth`` per
    cluster.

    All clusters grow together, each at its own minimum count, so k clusters cost as many
    jobs as one.  The rules come from the itemsets by joins (``rules_from_itemsets``).
    With ``staged`` the requested clusters' baskets are written once, partitioned by cluster, and
    read from there.  The baskets are spread over ``num_partitions`` (by default by their number: the
    written files are small for what they hold).  The mined itemsets stay cached; they are added
    to ``cached`` for the caller to release.  ``parallelism`` and ``band_ratio`` belonged to fits of
    several clusters at once and change nothing any more.
    """
    clusters = sorted(set(int(c) for c in clusters))
    spark = assignments.sparkSession
    if not clusters:
        return (spark.createDataFrame([], "cluster_id int, items array<string>, size int, freq long"),
                spark.createDataFrame([], "cluster_id int, antecedent array<string>, consequent array<string>, "
                                          "confidence double, lift double, support double"))
    source = assignments.where(F.col(cluster_col).isin(clusters))
    if staged:
        source, cluster_col, items_col = stage_by_cluster(source, cluster_col, items_col), "cluster_id", "items"
    counts = {int(r[0]): r[1] for r in source.groupBy(cluster_col).count().collect()}   # at most k rows
    parts = num_partitions or max(1, -(-sum(counts.values()) // ROWS_PER_PART))
    # dealt out as they are: reading the few files is then all that their tasks do
    baskets = keep(source.select(F.col(cluster_col).cast("int").alias("cluster_id"), F.col(items_col).alias("items"))
                   .repartition(parts).select("cluster_id", F.array_distinct("items").alias("items")))
    found = grow_itemsets(baskets, counts, min_support)
    baskets.unpersist()
    if cached is not None:
        cached.append(found)
    sets = found.select("cluster_id", F.array_sort("items").alias("items"), F.size("items").alias("size"), "freq")
    sizes = spark.createDataFrame(list(counts.items()), "cluster_id int, n long")
    return sets, rules_from_itemsets(sets, sizes, min_confidence)
