"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``.

A staged frame is written once and read back: its lineage is cut, a lost
executor costs nothing, and nothing is kept in executors' memory or on their
disks.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from navforge.session import ensure_checkpoint_dir

_LOCAL = threading.local()


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def staged(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written under the shared folder and read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{tag}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    if not hasattr(_LOCAL, "paths"):
        _LOCAL.paths = []
    _LOCAL.paths.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release_staged() -> None:
    """Delete what this thread staged (call once the jobs that read it have run)."""
    paths = getattr(_LOCAL, "paths", [])
    while paths:
        delete_path(*paths.pop())
