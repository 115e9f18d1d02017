"""Must-link-constrained Jaccard k-means: one customer, one cluster.

Stated as relational steps (fit = one Spark action, the seed draw; links,
assignments and centroids are lazy and cached on first use):

  seeds(basket_id, cluster_id)   k baskets first in md5('<seed>:<basket_id>') order,
                                 numbered 0..k-1 in that order
  nearest(basket)                arg-min (jaccard(seed, basket), cluster_id), NaN last
  anchor(customer)               nearest of the customer's lowest non-seed basket id
  link(customer)                 least(anchor, lowest cluster of its seed baskets)
  label_0(basket)                seed ? own cluster : anchor(customer)
  label_t(basket), t >= 1        seed ? own cluster : link(customer)   (constant in t)
  c_1(j) = (seed_j + sum of non-seed rows with label_0 = j) / (1 + their count)
  c_t(j) = (c_{t-1}(j) + S_j) / (1 + n_j), S_j, n_j over non-seed rows with label_1 = j
  predict(basket, customer)      coalesce(link(customer), nearest seed)

Seeds stay in their own cluster even against their customer's link, and a
seed's own basket enters its cluster's mean.  Scoring uses the seed baskets by
default (``score_against="seeds"``); ``"centroids"`` scores against the trained
means, where only weights of exactly 0 or 1 count.

Scale: the k seeds are the only rows that reach the driver (k is a parameter);
distances are row-local against a literal array of the k seeds, so assigning
baskets adds no shuffle; they are computed once per customer (its anchor
basket) and for baskets without a link, never for every basket.  The link table is one hash aggregate on customer_id
over fixed-width values (partial aggregation makes a customer holding a third of all baskets cost one
row per map task); the items of one anchor basket per customer are fetched by a join on basket_id.  It is
joined back on customer_id, where AQE splits a hot
customer's partition.  Centroids are one aggregate on (cluster, category).

Since a known customer's label is a function of the customer, labelings of the
same baskets under several k are compared on one row per customer, weighted
with its number of baskets (``customer_table``).  The seeds of a smaller k are the first ones of a
larger, so the distances to the most seeds give the labels under every k: the running minimum over
the seeds is the label under each number of them (``labels_by_k``).

Baskets are sets of categories, either as bit words (column ``words``, whose metadata names the vocabulary;
used when it is there) or as arrays of names (column ``items``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketmine.functions.bitwords import names, pack, set_bits, unpack
from basketmine.functions.jaccard import Centres, set_distance
from basketmine.operators.encode import names_of
from basketmine.session import keep, md5_rank_key


def set_column(baskets: DataFrame) -> str:
    """The column with the category sets: bit words if there are any, else names."""
    return "words" if "words" in baskets.columns else "items"


def width(sets: list) -> int | None:
    """Number of words of sets that are bit words, None for sets of names."""
    return next((len(s) for s in sets if s and isinstance(s[0], int)), None)


def literal_set(values: list) -> Column:
    bits = values and isinstance(values[0], int)
    return F.array(*[F.lit(x) for x in values]).cast("array<bigint>" if bits else "array<string>")


def seed_centres(seeds: list) -> Centres:
    """Seeds ``(cluster_id, basket_id, set, ...)`` as centres."""
    return Centres([(c, held, None) for c, _, held, *_ in seeds], width([held for _, _, held, *_ in seeds]))


def seed_order(baskets: DataFrame, seed: int, id_col: str = "basket_id") -> DataFrame:
    return baskets.withColumn("_seed_key", md5_rank_key(seed, id_col))


def draw_seeds(baskets: DataFrame, k: int, seed: int) -> list[tuple[int, int, list[str]]]:
    """``[(cluster_id, basket_id, items)]`` for the k seed baskets.

    ``orderBy(...).limit(k)`` plans as a top-k (each task keeps k rows), so the
    whole input is never sorted.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    held = set_column(baskets)
    rows = (seed_order(baskets.select("basket_id", held), seed)
            .orderBy("_seed_key", "basket_id").limit(k).collect())
    if len(rows) < k:
        raise ValueError(f"k={k} is larger than the number of baskets ({len(rows)})")
    return [(cid, r["basket_id"], list(r[held] or [])) for cid, r in enumerate(rows)]


def seed_rows(baskets: DataFrame, k: int, seed: int) -> DataFrame:
    """``(basket_id, cluster_id)`` of the seeds, as a plan (a top-k; the window sees k rows)."""
    top = seed_order(baskets.select("basket_id"), seed).orderBy("_seed_key", "basket_id").limit(k)
    number = F.row_number().over(Window.orderBy("_seed_key", "basket_id")) - 1
    return top.select("basket_id", number.cast("int").alias("cluster_id"))


def anchor_baskets(base: DataFrame, seed_ids: list[int]) -> DataFrame:
    """``(customer_id, n_baskets, anchor_id, anchor_items)`` of every known customer: the lowest basket
    that is none of ``seed_ids`` (NULL if it has no other).  One hash aggregate over the baskets, then a
    join on basket_id that fetches the items of one basket per customer."""
    is_seed = F.col("basket_id").isin(seed_ids)
    per = base.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_baskets"), F.min(F.when(~is_seed, F.col("basket_id"))).alias("anchor_id"))
    items = base.where(F.col("customer_id").isNotNull()).select(
        F.col("basket_id").alias("anchor_id"), F.col(set_column(base)).alias("anchor_items"))
    return per.join(items, "anchor_id", "left").select("customer_id", "n_baskets", "anchor_id", "anchor_items")


def customer_table(baskets: DataFrame, k_max: int, seed: int = 1) -> tuple[DataFrame, list]:
    """What every labelling by up to ``k_max`` seeds depends on: one row per known customer
    (``n_baskets``, the lowest basket that is no seed) and one per basket without a customer.
    Returns it with the seeds ``(cluster_id, basket_id, items, customer_id)``."""
    held = set_column(baskets)
    base = baskets.select("basket_id", "customer_id", held)
    rows = (seed_order(base, seed).orderBy("_seed_key", "basket_id").limit(k_max).collect())     # k_max rows
    if len(rows) < k_max:
        raise ValueError(f"k={k_max} is larger than the number of baskets ({len(rows)})")
    seeds = [(c, r["basket_id"], list(r[held] or []), r["customer_id"]) for c, r in enumerate(rows)]
    known = anchor_baskets(base, [b for _, b, _, _ in seeds])
    unknown = base.where(F.col("customer_id").isNull()).select(
        "customer_id", F.lit(1).cast("long").alias("n_baskets"), F.col("basket_id").alias("anchor_id"),
        F.col(held).alias("anchor_items"))
    return known.unionByName(unknown), seeds


def labels_by_k(rows: DataFrame, seeds: list, ks: list[int]) -> DataFrame:
    """``(k, label_a, label_b, n_baskets)``: the ``predict`` labels of the rows of ``customer_table`` under the models with
    the first k and the first k + 1 seeds, for each of the consecutive ``ks``.

    The distances to all seeds are computed once per row; their running minimum is the label under each k.
    Customers that own a seed are at most as many as there are seeds: their rows are labelled on the
    driver, since their anchor depends on k (seeds from k on are ordinary baskets)."""
    top = ks[-1] + 1
    owners = sorted({customer for *_, customer in seeds if customer is not None})
    owned = F.coalesce(F.col("customer_id").isin(owners), F.lit(False))
    kind = "array<struct<d: double, cid: int>>"
    first = F.array(F.array_min(F.slice("_d", 1, ks[0]))).cast(kind)
    running = F.aggregate(F.slice("_d", ks[0] + 1, top - ks[0]), first,
                          lambda held, x: F.concat(held, F.array(F.least(F.element_at(held, -1), x)).cast(kind)))
    pairs = F.transform(F.lit(list(range(len(ks)))), lambda i: F.struct(
        (i + F.lit(ks[0])).alias("k"), F.get("_r", i)["cid"].alias("label_a"), F.get("_r", i + 1)["cid"].alias("label_b")))
    labelled = (rows.where(~owned)
                .select("n_baskets", seed_centres(seeds[:top]).distances(F.col("anchor_items")).cast(kind).alias("_d"))
                .select("n_baskets", running.alias("_r")).select("n_baskets", F.inline(pairs)))
    few = rows.where(owned).select("customer_id", "n_baskets", "anchor_id", "anchor_items").collect()    # at most one per seed
    labels = [{k: _owner_label(r, seeds, k) for k in [*ks, top]} for r in few]
    of_owners = rows.sparkSession.createDataFrame(
        [(r["n_baskets"], k, ls[k], ls[k + 1]) for r, ls in zip(few, labels) for k in ks],
        "n_baskets long, k int, label_a int, label_b int")
    return labelled.unionByName(of_owners).select("k", "label_a", "label_b", "n_baskets")


def _owner_label(row, seeds: list, k: int) -> int:
    """Label of a customer that owns seeds under the model with the first ``k`` seeds."""
    mine = [(basket, held) for _, basket, held, customer in seeds[k:] if customer == row["customer_id"]]
    if row["anchor_id"] is not None:
        mine.append((row["anchor_id"], list(row["anchor_items"] or [])))
    labels = [c for c, _, _, customer in seeds[:k] if customer == row["customer_id"]]
    if mine:
        anchor = min(mine, key=lambda b: b[0])[1]
        away = [(d != d, d, c) for d, c in ((set_distance(held, anchor), c) for c, _, held, _ in seeds[:k])]     # NaN last
        labels.append(min(away)[2])
    return min(labels)


def customer_label(seeds: list, k: int, centres=None) -> Column:
    """``predict`` label of the rows of ``customer_table`` under the model with the first ``k`` seeds.

    Seeds from ``k`` on are ordinary baskets of that model: where a customer's
    lowest one comes before its anchor, it is the anchor (at most ``k_max``
    customers, told by a literal map).  ``centres``: what rows without a customer
    are scored against (default: the seeds).
    """
    centre = seed_centres(seeds[:k])
    near = centre.nearest(F.col("anchor_items"))["cid"]
    lowest: dict = {}      # customer -> its lowest basket among the later seeds
    own: dict = {}         # customer -> its lowest cluster among the first k seeds
    for c, basket, items, customer in seeds:
        if customer is None:
            continue
        if c < k:
            own[customer] = min(own.get(customer, c), c)
        elif customer not in lowest or basket < lowest[customer][0]:
            lowest[customer] = (basket, items)
    anchor = F.when(F.col("anchor_id").isNotNull(), near)
    for customer, (basket, items) in lowest.items():
        mine = (F.col("customer_id") == customer) & (F.col("anchor_id").isNull() | (F.col("anchor_id") > basket))
        anchor = F.when(mine, centre.nearest(literal_set(items))["cid"]).otherwise(anchor)
    seeded = F.lit(None).cast("int")
    if own:
        seeded = F.try_element_at(F.create_map(*[F.lit(x) for pair in own.items() for x in pair]), F.col("customer_id"))
    free = near if centres is None else centres.nearest(F.col("anchor_items"))["cid"]
    return F.when(F.col("customer_id").isNull(), free).otherwise(F.least(anchor, seeded))


def with_customer_rows(baskets: DataFrame, per_customer: DataFrame) -> DataFrame:
    """``baskets`` left-joined to one row per customer.  Baskets without a customer are united in
    afterwards with NULLs: they would all hash to one partition of the join."""
    known = baskets.where(F.col("customer_id").isNotNull()).join(per_customer, "customer_id", "left")
    return known.unionByName(baskets.where(F.col("customer_id").isNull()), allowMissingColumns=True)


@dataclass
class ConstrainedKMeansModel:
    k: int
    iterations: int
    seed: int
    seeds: list[tuple[int, int, list]]
    links: DataFrame          # customer_id, anchor, cluster_id
    assignments: DataFrame    # basket_id, customer_id, items, is_seed, seed_cluster, label_0, cluster_id
    centroids: DataFrame      # cluster_id, category, weight
    base: DataFrame           # the encoded baskets, cached by fit unless the caller had
    own_base: bool = False
    vocab: list[str] | None = None      # of sets that are bit words
    cached: list[DataFrame] = field(default_factory=list, repr=False)
    _centroid_cache: list | None = field(default=None, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.assignments.sparkSession

    def seeds_df(self) -> DataFrame:
        return self.spark.createDataFrame([(b, c) for c, b, _ in self.seeds], "basket_id long, cluster_id int")

    def seed_centres(self) -> Centres:
        return seed_centres(self.seeds)

    def centroid_centres(self) -> Centres:
        """Literal centres from the trained means; k x categories values reach the driver."""
        if self._centroid_cache is None:
            rows = (self.centroids.groupBy("cluster_id")
                    .agg(F.array_sort(F.collect_list(F.when(F.col("weight") == 1.0, F.col("category")))).alias("ones"),
                         F.array_sort(F.collect_list(F.when(F.col("weight") != 0.0, F.col("category")))).alias("support"))
                    .collect())
            by_id = {r["cluster_id"]: (list(r["ones"]), list(r["support"])) for r in rows}
            self._centroid_cache = [(c, *by_id.get(c, ([], []))) for c in range(self.k)]
        if self.vocab is None:
            return Centres(self._centroid_cache)
        number, n = {name: i for i, name in enumerate(self.vocab)}, width([held for _, _, held in self.seeds])
        return Centres([(c, *(pack([number[x] for x in held], n) for held in sets)) for c, *sets in self._centroid_cache], n)

    def _centres(self, score_against: str) -> Centres:
        return self.seed_centres() if score_against == "seeds" else self.centroid_centres()

    def _set_column(self, items_col: str | None) -> str:
        return items_col or ("items" if self.vocab is None else "words")

    def distances(self, baskets: DataFrame, score_against: str = "seeds", items_col: str | None = None) -> DataFrame:
        """``(basket_id, cluster_id, distance)`` for every basket and every centre
        (k rows per basket)."""
        held = F.col(self._set_column(items_col))
        return (baskets.select("basket_id", F.explode(self._centres(score_against).distances(held)).alias("x"))
                .select("basket_id", F.col("x.cid").alias("cluster_id"), F.col("x.d").alias("distance")))

    def nearest(self, baskets: DataFrame, score_against: str = "seeds", items_col: str | None = None) -> DataFrame:
        held = F.col(self._set_column(items_col))
        return baskets.withColumn("_near", self._centres(score_against).nearest(held)) \
            .withColumn("nearest_cluster", F.col("_near.cid")) \
            .withColumn("nearest_distance", F.col("_near.d")).drop("_near")

    def predict(self, baskets: DataFrame, score_against: str = "seeds", items_col: str | None = None,
                output_col: str = "prediction") -> DataFrame:
        """Known customer -> its link; otherwise the nearest centre (K7).  The
        distance to the centres is evaluated only for rows without a link.
        Rows without a customer have no link to look up and stay out of the join."""
        near = self._centres(score_against).nearest(F.col(self._set_column(items_col)))["cid"]
        if "customer_id" not in baskets.columns:        # anonymous baskets: no link to use
            baskets = baskets.withColumn("customer_id", F.lit(None).cast("long"))
        links = self.links.select("customer_id", F.col("cluster_id").alias("_link"))
        return (with_customer_rows(baskets, links)
                .withColumn("known_customer", F.col("_link").isNotNull())
                .withColumn(output_col, F.coalesce(F.col("_link"), near))
                .drop("_link"))

    def cluster_baskets(self, clusters: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
        """Training baskets (seeds excluded) of the given clusters."""
        wanted = clusters.select(F.col(cluster_col).alias("cluster_id")).distinct()
        return (self.assignments.where(~F.col("is_seed"))
                .join(wanted, "cluster_id", "left_semi"))

    def cluster_summary(self) -> DataFrame:
        """Per cluster (A2): baskets and distinct customers under the final
        assignment, and the customers on its initial constraint list (distinct
        customers whose baskets got the cluster in the first pass).  Two
        aggregates over the assignments, joined on at most k rows."""
        final = self.assignments.groupBy("cluster_id").agg(
            F.count(F.lit(1)).alias("n_baskets"), F.countDistinct("customer_id").alias("n_customers"))
        initial = (self.assignments.where(F.col("customer_id").isNotNull())
                   .select(F.col("label_0").alias("cluster_id"), "customer_id").distinct()
                   .groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_listed_customers")))
        return (final.join(initial, "cluster_id", "full")
                .select("cluster_id", F.coalesce("n_baskets", F.lit(0)).alias("n_baskets"),
                        F.coalesce("n_customers", F.lit(0)).alias("n_customers"),
                        F.coalesce("n_listed_customers", F.lit(0)).alias("n_listed_customers")))

    def summarized_centroids(self, vocab: list[str]) -> DataFrame:
        """The centroids by MLlib's vector aggregate instead of category counts (A3): means of the 0/1 vectors of the
        clusters under the first and the final labels, combined as the iterations do.  ``cluster_id, category, weight``."""
        from basketmine.operators.encode import to_vectors
        from basketmine.operators.kmeans import member_means
        rows = to_vectors(self.assignments, vocab, features_col="_v")
        first = F.coalesce("seed_cluster", "label_0")       # the seed's own basket enters the first mean
        c1 = member_means(rows.select("_v", first.alias("j")), "j", "_v").select("label", F.col("mean").alias("_c1"))
        later = member_means(rows.where(~F.col("is_seed")).select("_v", F.col("cluster_id").alias("j")), "j", "_v")
        shrink = F.pow((F.col("n") + 1).cast("double"), F.lit(float(self.iterations - 1)))
        settled = F.when(F.col("mean").isNull(), F.col("_c1")).otherwise(F.zip_with("mean", "_c1", lambda s, c: s + (c - s) / shrink))
        if self.iterations == 0:
            c1 = member_means(rows.where("is_seed").select("_v", F.col("seed_cluster").alias("j")), "j", "_v").select("label", F.col("mean").alias("_c1"))
        weights = settled if self.iterations >= 2 else F.col("_c1")
        cells = c1.join(later, "label", "left").select("label", F.posexplode(weights).alias("idx", "weight")).where("weight <> 0")
        table = self.spark.createDataFrame([(c, i) for i, c in enumerate(vocab)], "category string, idx int")
        return cells.join(table, "idx").select(F.col("label").alias("cluster_id"), "category", "weight")

    def reference_shaped(self, vocab: list[str]) -> DataFrame:
        """Assignments with a ``vector`` per row over ``vocab`` (J4): a seed row
        carries its cluster's mean weights, every other row its own 0/1 basket,
        made by the vectorizer.  Only the at most k seed rows meet the centroids."""
        from pyspark.ml.functions import array_to_vector

        from basketmine.operators.encode import to_vectors
        shape = ["basket_id", "customer_id", "is_seed", F.coalesce("seed_cluster", F.lit(-1)).alias("seed_cluster"),
                 "cluster_id", "vector"]
        rows = to_vectors(self.assignments.where(~F.col("is_seed")), vocab, features_col="vector").select(*shape)
        means = self.centroids.groupBy("cluster_id").agg(
            F.map_from_entries(F.collect_list(F.struct("category", "weight"))).alias("_w"))
        weights = F.transform(F.lit(vocab), lambda c: F.coalesce(F.try_element_at(F.col("_w"), c), F.lit(0.0)))
        seeds = (self.assignments.where("is_seed")
                 .join(means.withColumnRenamed("cluster_id", "seed_cluster"), "seed_cluster", "left")
                 .withColumn("vector", array_to_vector(F.coalesce(weights, F.array_repeat(F.lit(0.0), len(vocab))))))
        return rows.unionByName(seeds.select(*shape))

    def unpersist(self) -> None:
        for df in (self.links, *self.cached, self.centroids, *([self.base] if self.own_base else [])):
            df.unpersist()


class ConstrainedKMeans:
    """Estimator over encoded baskets ``(basket_id, customer_id, words)`` or ``(basket_id, customer_id, items)``.
    ``items_col``: another column with arrays of names to use."""

    def __init__(self, k: int, iterations: int = 5, seed: int = 1, items_col: str | None = None):
        if iterations < 0:
            raise ValueError("iterations must be >= 0")
        self.k, self.iterations, self.seed, self.items_col = k, iterations, seed, items_col

    def fit(self, baskets: DataFrame) -> ConstrainedKMeansModel:
        """One action: the seed draw (top-k).  Links, assignments and centroids are
        lazy: each is computed, and cached, when it is first read.  The encoded
        input is cached until ``unpersist`` unless the caller has cached it already."""
        own_cache = not baskets.is_cached
        held = "items" if self.items_col else set_column(baskets)
        vocab = names_of(baskets) if held == "words" else None
        base = baskets.select("basket_id", "customer_id", F.col(self.items_col).alias("items") if self.items_col else held)
        if own_cache:
            base = keep(base)
        seeds = draw_seeds(base, self.k, self.seed)
        seed_of = F.create_map(*[x for c, b, _ in seeds for x in (F.lit(b), F.lit(c))])
        centres = seed_centres(seeds)

        flagged = (base
                   .withColumn("seed_cluster", F.try_element_at(seed_of, F.col("basket_id")).cast("int"))
                   .withColumn("is_seed", F.col("seed_cluster").isNotNull()))

        # One row per customer.  The anchor is the nearest seed of the
        # customer's lowest non-seed basket, so distances are computed once per
        # customer, not once per basket.  Seed baskets are at most k rows.
        seeded = (flagged.where("is_seed AND customer_id IS NOT NULL")
                  .groupBy("customer_id").agg(F.min("seed_cluster").alias("_seed_min")))
        links = keep(anchor_baskets(base, [b for _, b, _ in seeds]).join(seeded, "customer_id", "left")
                     .withColumn("anchor", F.when(F.col("anchor_id").isNotNull(),
                                                  centres.nearest(F.col("anchor_items"))["cid"]))
                     .select("customer_id", "anchor", F.least("anchor", "_seed_min").alias("cluster_id")))

        # Baskets without a customer have no link: their own nearest seed
        # (coalesce evaluates it only for them).
        own = centres.nearest(F.col(held))["cid"]
        label0 = F.when(F.col("is_seed"), F.col("seed_cluster")).otherwise(F.coalesce("anchor", own))
        label1 = F.when(F.col("is_seed"), F.col("seed_cluster")).otherwise(F.coalesce("_link", own))
        assignments = keep(
            with_customer_rows(flagged, links.select("customer_id", "anchor", F.col("cluster_id").alias("_link")))
            .select("basket_id", "customer_id", held, "is_seed", "seed_cluster",
                    label0.alias("label_0"),
                    (label1 if self.iterations >= 1 else label0).alias("cluster_id")))
        centroids = keep(self._centroids(assignments, seeds, vocab))   # k x categories rows
        named = assignments if vocab is None else assignments.withColumn("items", names(F.col("words"), vocab))
        return ConstrainedKMeansModel(self.k, self.iterations, self.seed, seeds, links, named, centroids,
                                      base, own_cache, vocab, [assignments])

    def _centroids(self, assignments: DataFrame, seeds, vocab: list[str] | None) -> DataFrame:
        spark = assignments.sparkSession
        if vocab is None:
            kind, listed, sets = "string", F.col("items"), seeds
        else:       # counted by category number, named at the end
            kind, listed = "int", set_bits(F.col("words"), width([held for _, _, held in seeds]))
            sets = [(c, b, unpack(words)) for c, b, words in seeds]

        def named(cells: DataFrame) -> DataFrame:
            if vocab is None:
                return cells
            return cells.withColumn("category", F.element_at(F.array(*[F.lit(v) for v in vocab]), F.col("category") + 1))

        seed_long = spark.createDataFrame(
            [(c, cat) for c, _, held in sets for cat in held] or [(0, None)],
            f"cluster_id int, category {kind}").where(F.col("category").isNotNull())
        if self.iterations == 0:
            return named(seed_long).withColumn("weight", F.lit(1.0))

        # One row per (which labelling, cluster, category) and one per seed
        # category (w = -1); a NULL category counts the baskets themselves, so
        # empty baskets enter the counts.  One aggregate over the assignments.
        labels = [F.struct(F.lit(0).alias("w"), F.col("label_0").alias("c"))]
        if self.iterations >= 2:
            labels.append(F.struct(F.lit(1).alias("w"), F.col("cluster_id").alias("c")))
        counts = (assignments.where(~F.col("is_seed"))
                  .select(F.explode(F.array(*labels)).alias("l"),
                          F.explode(F.concat(listed, F.array(F.lit(None).cast(kind)))).alias("category"))
                  .groupBy(F.col("l.w").alias("w"), F.col("l.c").alias("cluster_id"), "category")
                  .agg(F.count(F.lit(1)).alias("n"))
                  .unionByName(seed_long.select(F.lit(-1).alias("w"), "cluster_id", "category",
                                                F.lit(1).cast("long").alias("n"))))
        # at most 2 x k x (categories + 1) rows from here on
        per_cluster = Window.partitionBy("cluster_id")

        def size(w: int):
            """Baskets of the cluster under labelling w (the NULL-category rows)."""
            return F.coalesce(F.sum(F.when((F.col("w") == w) & F.col("category").isNull(), F.col("n")))
                              .over(per_cluster), F.lit(0))

        def part(w: int):
            """Count of the category's rows from source w (-1: the seed itself)."""
            return F.sum(F.when(F.col("w") == w, F.col("n")).otherwise(0))

        joined = (counts.withColumn("n0", size(0)).withColumn("n1", size(1))
                  .where(F.col("category").isNotNull())
                  .groupBy("cluster_id", "category")
                  .agg(part(-1).alias("sd"), part(0).alias("s0"), part(1).alias("s1"),
                       F.first("n0").alias("n0"), F.first("n1").alias("n1")))
        # c_t = (c_(t-1) + S) / (n + 1) in closed form: the distance to the mean S / n shrinks by n + 1 each time
        first = (F.col("sd") + F.col("s0")).cast("double") / (F.col("n0") + 1).cast("double")
        mean = F.col("s1").cast("double") / F.col("n1").cast("double")
        shrunk = (first - mean) / F.pow((F.col("n1") + 1).cast("double"), F.lit(float(max(self.iterations - 1, 0))))
        w = F.when(F.col("n1") == 0, first).otherwise(mean + shrunk) if self.iterations >= 2 else first
        return named(joined.select("cluster_id", "category", w.alias("weight")).where(F.col("weight") != 0.0))
