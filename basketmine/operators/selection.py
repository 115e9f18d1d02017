"""Choosing k by the ARI of consecutive models (K8 constrained, K9 plain
k-means) and the selection log (S6).

Rule: walking k = lo, lo+1, ... < hi, compare the labels of models k and k+1;
stop at the first k whose ARI is >= 0 and below the previous ARI (0.0 before
the first trial) and return that k; otherwise return the last k+1 tried, or 0
when the range is empty.  Each model k+1 is reused as the next model k.

Both walks can be logged and taken up again: with a ``log_path``, trials that the log already holds for the
walk's ``run`` are not computed again, and each is logged once.  A run names one walk over one set of
baskets with one set of parameters; new data need a new name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketmine.operators.ckmeans import ConstrainedKMeans, customer_label, customer_table, labels_by_k, set_column
from basketmine.operators.kmeans import fit_kmeans, kmeans_labels
from basketmine.operators.metrics import adjusted_rand_index, ari_table
from basketmine.session import keep, keep_on_disk
from basketmine.sources.sinks import append_trials, logged_trials

TRIALS_SCHEMA = "k int, k_next int, ari double"


def stops(ari: float, previous: float) -> bool:
    """NaN never stops the walk (both comparisons are false)."""
    return (not math.isnan(ari)) and ari >= 0.0 and ari < previous


def best_k(trials: list[tuple[int, int, float]]) -> int:
    best, previous = 0, 0.0
    for k, k_next, ari in trials:
        if stops(ari, previous):
            return k
        best, previous = k_next, ari
    return best


def best_k_from_trials(trials: DataFrame) -> DataFrame:
    """The stop rule as a plan over a trials table ``(k, k_next, ari)``: the
    trials up to and including the stop, each with the resulting ``best_k``.

    The table has one row per tried k, so the un-partitioned window is small.
    """
    w = Window.orderBy("k")
    prev = F.lag("ari", 1, 0.0).over(w)
    flagged = trials.withColumn("_stop", (~F.isnan("ari")) & ~F.isnan(prev) & (F.col("ari") >= 0) & (F.col("ari") < prev))
    first_stop = F.min(F.when(F.col("_stop"), F.col("k"))).over(Window.partitionBy())
    upto = flagged.withColumn("_first", first_stop).where(F.col("_first").isNull() | (F.col("k") <= F.col("_first")))
    best = F.coalesce(F.col("_first"), F.max("k_next").over(Window.partitionBy()))
    return upto.withColumn("best_k", best).select("k", "k_next", "ari", "best_k")


def _log(spark: SparkSession, trials: list[tuple[int, int, float]], log_path: str | None, run: str) -> None:
    if log_path and trials:
        append_trials(spark.createDataFrame(trials, TRIALS_SCHEMA), log_path, run)


def _resume(spark: SparkSession, log_path: str | None, run: str, lo: int, hi: int) -> tuple[list[tuple[int, int, float]], bool]:
    """The logged trials from ``lo`` on without a gap, up to the stop, and whether they end the walk."""
    logged = {k: (k, k_next, ari) for k, k_next, ari in logged_trials(spark, log_path, run)} if log_path else {}
    trials: list[tuple[int, int, float]] = []
    while lo + len(trials) in logged and lo + len(trials) < hi:
        trials.append(logged[lo + len(trials)])
        if _stopped(trials):
            return trials, True
    return trials, lo + len(trials) >= hi


def _stopped(trials: list[tuple[int, int, float]]) -> bool:
    return bool(trials) and stops(trials[-1][2], trials[-2][2] if len(trials) > 1 else 0.0)


#: k values whose trials are one Spark job; a walk computes at most this many trials past its stop
BLOCK_OF_K = 16


def constrained_trials(rows: DataFrame, seeds: list, ks: list[int]) -> list[tuple[int, int, float]]:
    """The trials of consecutive ``ks`` in one job: one contingency keyed by k over the customers (``labels_by_k``)."""
    found = ari_table(labels_by_k(rows, seeds, ks), weight="n_baskets", by=("k",)).select("k", "ari").collect()
    ari = {r["k"]: float("nan") if r["ari"] is None else r["ari"] for r in found}
    return [(k, k + 1, ari[k]) for k in ks]


def select_k_constrained(baskets: DataFrame, lo: int, hi: int, iterations: int = 1, seed: int = 1,
                         log_path: str | None = None, score_against: str = "seeds", run: str | None = None,
                         block: int = BLOCK_OF_K):
    """Walk k over ``[lo, hi)`` with constrained models; labels are each
    model's ``predict`` of every training basket.  Returns ``(best_k, trials)``.

    The baskets are aggregated once, to one row per customer (``customer_table``).  Against the seeds, all
    trials of a block of k come from one contingency of those rows, keyed by k and weighted with their
    numbers of baskets.  With ``score_against="centroids"`` a model's means are fitted for the baskets
    without a customer, so each trial is a job of its own."""
    spark = baskets.sparkSession
    run = run or f"constrained-{score_against}-{iterations}-{seed}"
    trials, done = _resume(spark, log_path, run, lo, hi)
    if lo < hi and not done:
        base = keep(baskets.select("basket_id", "customer_id", set_column(baskets)))
        rows, seeds = customer_table(base, hi, seed)
        rows = keep(rows)
        at = lo + len(trials)
        while at < hi and not done:
            if score_against == "seeds":
                some = constrained_trials(rows, seeds, list(range(at, min(hi, at + block))))
            else:
                some = [(at, at + 1, _centroid_trial(base, rows, seeds, at, iterations, seed))]
            fresh = []
            for trial in some:
                fresh.append(trial)
                trials.append(trial)
                if _stopped(trials):
                    done = True
                    break
            _log(spark, fresh, log_path, run)
            at = lo + len(trials)
        rows.unpersist()
        base.unpersist()
    return best_k(trials), spark.createDataFrame(trials, TRIALS_SCHEMA)


def _centroid_trial(base: DataFrame, rows: DataFrame, seeds: list, k: int, iterations: int, seed: int) -> float:
    def label(n: int):
        model = ConstrainedKMeans(n, iterations, seed).fit(base)
        centres = model.centroid_centres()
        model.unpersist()
        return customer_label(seeds, n, centres)
    return adjusted_rand_index(rows.select(label(k).alias("label_a"), label(k + 1).alias("label_b"), "n_baskets"), weight="n_baskets")


def select_k_kmeans(vectors: DataFrame, lo: int, hi: int, max_iter: int = 10, seed: int = 1,
                    features_col: str = "features", log_path: str | None = None,
                    run: str | None = None, first: list | None = None):
    """Same walk over MLlib k-means models (K9), each fitted once.

    The vectors are stored once, on disk (unless the caller has cached them).  A trial labels them by its two models in the
    pass that counts the labels, so no labelled copy of the vectors is made and the lineage does not grow with the walk.

    ``first``: a list that gets the labelled rows of the first trial (``label_a`` of the walk's first model,
    ``label_b``) without their vectors, stored, for callers that need them; they are theirs to release."""
    spark = vectors.sparkSession
    run = run or f"kmeans-{max_iter}-{seed}"
    trials, done = _resume(spark, log_path, run, lo, hi)
    k = lo + len(trials)
    if k < hi and not done:
        base = vectors if vectors.is_cached else keep_on_disk(vectors)
        model = fit_kmeans(base, k, max_iter, seed, features_col)
        wanted = first
        while k < hi:
            nxt = fit_kmeans(base, k + 1, max_iter, seed, features_col)
            both = kmeans_labels(nxt, kmeans_labels(model, base, "label_a"), "label_b").drop(features_col)
            if wanted is not None:
                wanted.append(keep_on_disk(both))
                wanted = None
            trials.append((k, k + 1, adjusted_rand_index(both, "label_a", "label_b")))
            _log(spark, trials[-1:], log_path, run)
            if _stopped(trials):
                break
            model = nxt
            k += 1
        base.unpersist()
    return best_k(trials), spark.createDataFrame(trials, TRIALS_SCHEMA)
