"""Plain k-means (K1, K2) and cluster-stratified surrogate customer ids (K3)."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmine.session import keep, md5_bucket


def fit_kmeans(vectors: DataFrame, k: int, max_iter: int = 5, seed: int = 1,
               features_col: str = "features") -> KMeansModel:
    """MLlib k-means with k-means|| initialisation (K1)."""
    return KMeans(k=k, maxIter=max_iter, initMode="k-means||", seed=seed,
                  featuresCol=features_col, predictionCol="prediction").fit(vectors)


def kmeans_labels(model: KMeansModel, vectors: DataFrame, output_col: str = "prediction") -> DataFrame:
    """Nearest MLlib centre per row (K2)."""
    return model.setPredictionCol(output_col).transform(vectors)


def member_means(labelled: DataFrame, label_col: str, features_col: str = "features") -> DataFrame:
    """``label, n, mean`` (array) of the vectors under each label, by MLlib's vector aggregate."""
    summary = Summarizer.metrics("mean", "count").summary(F.col(features_col))
    return (labelled.groupBy(F.col(label_col).alias("label")).agg(summary.alias("_s"))
            .select("label", F.col("_s.count").alias("n"), vector_to_array(F.col("_s.mean")).alias("mean")))


def step_gap(before: KMeansModel, after: KMeansModel, vectors: DataFrame, features_col: str = "features",
             tolerance: float = 1e-9) -> DataFrame:
    """How far ``after`` is from one Lloyd step on ``before`` (K1, K2 in numbers): one row with ``n_clusters`` that have
    members, ``n_off`` cells in which a centre of ``after`` differs from the mean of the members under ``before``,
    and ``cost_off``, the relative difference of the members' cost from ``after``'s training cost.

    A fit with one more iteration from the same start is such a step, so both are 0 for it."""
    centre = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in before.clusterCenters()])       # k x categories values
    labelled = kmeans_labels(before, vectors, "_label")
    squares = F.zip_with(vector_to_array(F.col(features_col)), F.get(centre, F.col("_label")), lambda x, c: (x - c) * (x - c))
    cost = labelled.agg(F.sum(F.aggregate(squares, F.lit(0.0), lambda s, y: s + y)).alias("cost"))
    centres = vectors.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(after.clusterCenters())], "label int, centre array<double>")
    gaps = F.zip_with("mean", "centre", lambda a, b: F.abs(a - b) > tolerance)
    off = member_means(labelled, "_label", features_col).join(centres, "label").agg(
        F.count(F.lit(1)).alias("n_clusters"), F.sum(F.size(F.filter(gaps, lambda g: g))).alias("n_off"))
    trained = after.summary.trainingCost
    gap = F.abs(F.lit(float(cost.first()["cost"])) - trained) / trained
    return off.withColumn("cost_off", gap)


def surrogate_customer_ids(df: DataFrame, label_col: str, k: int, n_customers: int, seed: int = 1,
                           id_col: str = "basket_id", output_col: str = "customer_id") -> DataFrame:
    """Cluster i gets customer ids in ``[i*m + 1, (i+1)*m]``, ``m = n_customers // k``;
    the id inside that range is ``1 + md5('<seed>:<basket_id>') mod m`` (K3).

    A hash instead of a random draw makes the ids the same on every recompute
    and on every executor.
    """
    m = n_customers // k
    if m < 1:
        raise ValueError("n_customers must be at least k")
    bucket = md5_bucket(seed, id_col, m)
    return df.withColumn(output_col, F.col(label_col).cast("long") * F.lit(m) + F.lit(1) + bucket)


def assign_customer_ids(vectors: DataFrame, k: int, n_customers: int, max_iter: int = 5, seed: int = 1,
                        features_col: str = "features") -> DataFrame:
    """K1 + K2 + K3: cluster the basket vectors, then draw ids per cluster.
    The vectors are cached (unless already) since both the fit and the
    labelling read them."""
    if not vectors.is_cached:
        vectors = keep(vectors)
    model = fit_kmeans(vectors, k, max_iter, seed, features_col)
    labelled = kmeans_labels(model, vectors, "_kmeans_label")
    return surrogate_customer_ids(labelled, "_kmeans_label", k, n_customers, seed).drop("_kmeans_label")
