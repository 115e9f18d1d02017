"""Session settings and small plan helpers shared by every module."""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Session defaults for a cluster run; the caller's own settings win.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # baskets as bit words are some 20 bytes: a megabyte of them is work for several cores
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # let AQE coalesce / split the output of cached plans too
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "basketmine", driver_memory: str | None = None) -> SparkSession:
    """Return a session with AQE and skew-join handling switched on.

    ``master``, ``shuffle_partitions`` and ``driver_memory`` are for local runs
    and tests (in local mode the executors live in the driver JVM); on a
    cluster leave them unset and let the submitter decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in CLUSTER_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local runs.

    On a cluster the folder must be named by ``spark.checkpoint.dir`` (a shared
    file system); a machine-local folder would not survive an executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    local = tempfile.mkdtemp(prefix="basketmine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder (reliable, eager);
    the result reads the checkpoint files and keeps no lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if df.is_cached:
        df.unpersist()
    return out


def keep(df: DataFrame) -> DataFrame:
    """Cache a DataFrame that several actions read; lost blocks recompute from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def keep_on_disk(df: DataFrame) -> DataFrame:
    """``keep`` without a place on the heap, for rows that many actions read and that can outgrow the executors' memory.

    A block in memory lies there as byte arrays of just over a megabyte, which take two regions each on a heap of
    2 GB or less: it is full before Spark's storage memory is, so that nothing is evicted in time."""
    return df.persist(StorageLevel.DISK_ONLY)


def md5_rank_key(seed: int | str, key_col: str):
    """Deterministic pseudo-random order key: ``md5('<seed>:<key>')``.

    DuckDB's ``md5`` gives the same hex string, so orders built on it can be
    checked by SQL.
    """
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key_col).cast("string")))


def md5_bucket(seed: int | str, key_col: str, m):
    """Deterministic integer in ``[0, m)`` from the first 60 bits of the md5 key."""
    h = F.conv(F.substring(md5_rank_key(seed, key_col), 1, 15), 16, 10).cast("long")
    return F.pmod(h, F.lit(m) if isinstance(m, int) else m)
