"""How often each key occurred in each load: a bucketed table of keys.

The table is divided by load and, within a load, bucketed by key, so that the keys of
a new load are shuffled once, when they are written, and then meet all earlier keys
bucket by bucket: the earlier ones are read but not shuffled (or, if the new keys are
few, Spark broadcasts those).  Rows with a NULL key part are not in it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navforge.operators.joins import all_not_null
from navforge.sources.sinks import _hadoop

EARLIER = "__earlier"
TOTAL = "__total"


@dataclass(frozen=True)
class KeyIndex:
    """``buckets`` counts for a new index only; an existing one keeps its number (its
    folder's name).  Take as many as a load's keys fill with some 100 MB each."""

    path: str
    key: tuple[str, ...]
    buckets: int = 64

    def _open(self, spark: SparkSession) -> tuple[str, int]:
        """(table, buckets): the index named in this session's catalog."""
        jvm, fs, root = _hadoop(spark, self.path)
        found = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        buckets = next((int(n.split("-")[1]) for n in found if n.startswith("buckets-")),
                       self.buckets)
        folder = f"{root.toString().rstrip('/')}/buckets-{buckets}"
        table = f"key_index_{zlib.crc32(folder.encode()):08x}"
        keys = ", ".join(f"`{k}`" for k in self.key)
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} "
                  f"({', '.join(f'`{k}` STRING' for k in self.key)}, n BIGINT, load INT) "
                  f"USING parquet PARTITIONED BY (load) CLUSTERED BY ({keys}) "
                  f"INTO {buckets} BUCKETS LOCATION '{folder.replace(chr(39), chr(39) * 2)}'")
        spark.sql(f"MSCK REPAIR TABLE {table}")  # loads that another session added
        return table, buckets

    def add(self, rows: DataFrame, load: int) -> None:
        """Record the keys of a load; the same load again replaces its own record."""
        spark = rows.sparkSession
        table, buckets = self._open(spark)
        counts = (rows.where(all_not_null(self.key)).groupBy(*self.key)
                  .agg(F.count(F.lit(1)).alias("n"))  # a hot key is one row before it moves on
                  .repartition(buckets, *self.key))
        columns = ", ".join(f"`{c}`" for c in (*self.key, "n"))
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (load = {int(load)}) "
                  f"SELECT {columns} FROM {{counts}}", counts=counts)

    def repeated(self, spark: SparkSession, load: int) -> DataFrame:
        """Keys of a load that occur more than once up to it: how often in all
        (``__total``), and whether in an earlier load (``__earlier``)."""
        table, _ = self._open(spark)
        index, key = spark.table(table), list(self.key)
        new = index.where(F.col("load") == load).select(*key, "n")
        before = (index.where(F.col("load") < load).join(new.select(*key), key, "left_semi")
                  .groupBy(*key).agg(F.sum("n").alias("__before")))
        total = F.col("n") + F.coalesce(F.col("__before"), F.lit(0))
        return (new.join(before, key, "left")
                .select(*key, total.alias(TOTAL), F.col("__before").isNotNull().alias(EARLIER))
                .where(F.col(TOTAL) > 1))
