"""Sinks: key-sorted output (S4, S5, R5), overwrite semantics (S8), the
selection log (S6) and mined results (S7)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tuple_text(key: str, *values: str) -> Column:
    """``(k,(v1,v2))`` or ``(k,v)`` text of one output line."""
    if len(values) == 1:
        inner = F.col(values[0]).cast("string")
    else:
        inner = F.concat(F.lit("("), F.concat_ws(",", *[F.col(v).cast("string") for v in values]), F.lit(")"))
    return F.concat(F.lit("("), F.col(key).cast("string"), F.lit(","), inner, F.lit(")"))


def write_sorted(df: DataFrame, path: str, key: str, fmt: str = "parquet", single_file: bool = False,
                 num_partitions: int | None = None, rows_per_file: int | None = None) -> None:
    """Write ``df`` ordered by ``key``, replacing what is at ``path``.

    The number of files follows the data: the range shuffle's partitions as AQE coalesces them by size,
    or with ``rows_per_file`` the number of rows (one count) over it; ``num_partitions`` sets it outright.

    Default: range-partitioned on the key and sorted inside each partition, so
    part files concatenated in name order are globally sorted and no task holds
    all rows.  ``single_file=True`` gives one sorted file (one task writes it;
    only for small outputs).  ``fmt="text"`` writes ``(k,(v1,v2))`` lines.
    """
    values = [c for c in df.columns if c != key]
    out = df.select(tuple_text(key, *values).alias("value"), F.col(key).alias("_k")) if fmt == "text" else df
    sort_key = "_k" if fmt == "text" else key
    if rows_per_file:
        num_partitions = max(1, -(-df.count() // rows_per_file))
    if single_file:
        out = out.orderBy(sort_key).coalesce(1)
    else:
        out = (out.repartitionByRange(num_partitions, sort_key) if num_partitions else out.repartitionByRange(sort_key))
        out = out.sortWithinPartitions(sort_key)
    if fmt == "text":
        out = out.select("value")
    out.write.mode("overwrite").format(fmt).save(path)


def append_trials(trials: DataFrame, path: str, run: str | None = None) -> None:
    """Log selection records ``(k, k_next, ari)`` (S6): appended, or with a ``run`` keyed by run and k, where a record that
    is logged again replaces itself (dynamic partition overwrite), so that a repeated walk leaves each trial once."""
    if run is None:
        trials.write.mode("append").parquet(path)
        return
    (trials.withColumn("run", F.lit(run)).repartition("k").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run", "k").parquet(path))


def logged_trials(spark: SparkSession, path: str, run: str) -> list[tuple[int, int, float]]:
    """The trials of a run that the log holds, in order of k; none if there is no log.  One row per trial."""
    try:
        log = spark.read.schema("k_next int, ari double, run string, k int").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [(r["k"], r["k_next"], r["ari"]) for r in log.where(F.col("run") == run).orderBy("k").collect()]


def write_results(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Mined itemsets / rules / assignments as parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
