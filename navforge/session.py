"""Session construction and shared-storage settings."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans from runtime statistics
# (partition coalescing, skew-join splitting of hot keys); UTC makes parsed
# dates independent of the machine.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "navforge", extra: dict[str, str] | None = None) -> SparkSession:
    """A session that leaves to the cluster what the cluster has set.

    Arguments given here win.  Otherwise the master and the number of shuffle
    partitions come from the submitted configuration; only where that names no
    master, ``local[*]`` with 8 shuffle partitions is used.
    """
    SparkContext._ensure_initialized()
    given = SparkConf()
    conf = {k: v for k, v in SESSION_CONF.items() if not given.contains(k)}
    if master is None and not given.contains("spark.master"):
        master = "local[*]"
    if shuffle_partitions is None and (master or "").startswith("local") \
            and not given.contains("spark.sql.shuffle.partitions"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if is_local(spark):
        ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """One machine and one process: every path is shared."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master falls back to a scratch folder; on a cluster an unset
    folder is an error, as executors would each write to their own disk.
    """
    d = checkpoint_dir(spark)
    if not d:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="navforge-ckpt-", dir=os.environ.get("NAVFORGE_SCRATCH"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def size_shuffles(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 128 << 20,
                  min_partitions: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` so the initial shuffle partitions of a
    job reading ``input_bytes`` hold about ``target_partition_bytes`` each (AQE then
    coalesces small ones and splits skewed ones).  Returns the number set."""
    floor = min_partitions or 2 * spark.sparkContext.defaultParallelism
    n = max(floor, -(-input_bytes // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    return n

