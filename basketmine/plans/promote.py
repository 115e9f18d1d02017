"""End to end (K12): encode the catalogue and baskets, train the constrained
model, score incoming baskets, and mine the rules of each predicted cluster.

The incoming side is a batch: every incoming basket is scored (R6 batch form)
and the baskets of the predicted clusters (at most k) are mined per cluster
(support relative to each cluster, see ``operators.mining.mine_clusters``).  The
output is the rules per predicted cluster and the cluster of every incoming
basket; rules are not filtered by a basket's own contents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmine.operators.ckmeans import ConstrainedKMeans, ConstrainedKMeansModel
from basketmine.operators.encode import encode_baskets
from basketmine.operators.mining import mine_clusters
from basketmine.session import keep


@dataclass
class Promotion:
    scored: DataFrame     # incoming basket_id, customer_id, items, prediction, known_customer, ...
    itemsets: DataFrame   # cluster_id, items, size, freq
    rules: DataFrame      # cluster_id, antecedent, consequent, confidence, lift, support
    cached: list[DataFrame] = field(default_factory=list)

    def baskets(self) -> DataFrame:
        """``(basket_id, customer_id, cluster_id)``: each incoming basket once; its promotions are the
        ``rules`` of its cluster."""
        return self.scored.select("basket_id", "customer_id", F.col("prediction").alias("cluster_id"))

    def per_basket(self) -> DataFrame:
        """For display: every incoming basket with every rule of its cluster, one row
        without a rule where the cluster has none."""
        return self.baskets().join(self.rules, "cluster_id", "left")

    def close(self) -> None:
        """Release what the promotion keeps cached."""
        for df in (self.scored, *self.cached):
            df.unpersist()


def promote(model: ConstrainedKMeansModel, incoming: DataFrame, min_support: float = 0.2,
            min_confidence: float = 0.2, num_partitions: int | None = None,
            score_against: str = "seeds") -> Promotion:
    """Score encoded incoming baskets and mine their clusters' baskets (P12):
    non-seed training baskets by their final cluster."""
    scored = keep(model.predict(incoming, score_against))     # read by the collect below and the output
    clusters = [r[0] for r in scored.select("prediction").distinct().collect()]  # at most k values
    members = model.assignments.where(~F.col("is_seed"))
    cached: list[DataFrame] = []
    itemsets, rules = mine_clusters(members, clusters, min_support, min_confidence, num_partitions, cached=cached)
    return Promotion(scored, itemsets, rules, cached)


def train_and_promote(training: DataFrame, incoming: DataFrame, catalog: DataFrame, k: int = 40,
                      iterations: int = 5, seed: int = 1, min_support: float = 0.2,
                      min_confidence: float = 0.2, match: str = "exact",
                      num_partitions: int | None = None) -> tuple[ConstrainedKMeansModel, Promotion]:
    """Long-form baskets ``(basket_id, customer_id, item)`` in, promotion out."""
    train_enc = encode_baskets(training, catalog, match)
    model = ConstrainedKMeans(k, iterations, seed).fit(train_enc)
    inc_enc = encode_baskets(incoming, catalog, match)
    return model, promote(model, inc_enc, min_support, min_confidence, num_partitions)


def promote_from_text(spark, baskets_path: str, catalog_path: str, incoming: list[tuple[int, int, str]],
                   k: int = 40, iterations: int = 5, id_clusters: int = 40, n_customers: int = 1000,
                   id_iterations: int = 5, seed: int = 1, min_support: float = 0.2,
                   min_confidence: float = 0.2, num_partitions: int | None = None,
                   match: str = "exact") -> tuple[ConstrainedKMeansModel, Promotion]:
    """The whole demo flow on text inputs: basket lines without customers and
    a ``product, path`` catalogue -> category sets -> plain k-means surrogate
    customer ids (``id_clusters`` clusters, ``n_customers`` ids) -> constrained
    model -> promotions for the incoming ``(basket_id, customer_id, line)``
    baskets.  Defaults are the demo configuration."""
    from basketmine.functions.catalog import explode_paths
    from basketmine.operators.encode import to_vectors, vocabulary
    from basketmine.operators.kmeans import assign_customer_ids
    from basketmine.sources.text import incoming_baskets, read_basket_lines, read_catalog

    levels = explode_paths(read_catalog(spark, catalog_path))
    vocab = vocabulary(levels)
    enc = encode_baskets(read_basket_lines(spark, baskets_path), levels, match, keys=("basket_id",))
    with_ids = assign_customer_ids(to_vectors(enc, vocab), id_clusters, n_customers, id_iterations, seed)
    model = ConstrainedKMeans(k, iterations, seed).fit(with_ids.select("basket_id", "customer_id", "items"))
    inc = encode_baskets(incoming_baskets(spark, incoming), levels, match)
    return model, promote(model, inc, min_support, min_confidence, num_partitions)
