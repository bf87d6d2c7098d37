"""Helpers shared by the operators: input tables, shared scratch tables, Arrow batches."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from navforge.session import ensure_checkpoint_dir

#: Bytes of text that a Python task expands into numpy arrays at a time.
SLICE_BYTES = 1 << 20
#: Rows of a narrow result sent back to Spark at a time.
OUT_ROWS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per application),
    so that the operators also run where it is not installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="navforge-"), "navforge.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


class Scratch:
    """Tables written in the shared folder of ``spark.checkpoint.dir``.

    A written table cuts lineage and survives lost executors.  ``drop`` removes
    one that later steps do not need.
    """

    def __init__(self, spark: SparkSession, tag: str):
        ship(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """The table as read back; ``by``: a folder ``name/by=value`` for each value."""
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read
        if like is not None:
            reader = reader.schema(like.schema)
        return reader.parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps.

    The cleaner acts once the driver's garbage collector has found the old
    plans unreachable; between the passes of a long operator that is worth
    asking for, as each pass may have shuffled as much as the input.  It takes
    two rounds: the first frees the plans, the second what they referred to.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
                ) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Split a batch so that each part holds about ``limit`` bytes of text (one
    longer text is a part of its own).  Yields the part and its texts as UTF-8
    bytes, null as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if not pa.types.is_binary(col.type) and not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
    start, size, texts = 0, 0, []
    for i, v in enumerate(col):
        b = v.as_py() or b""
        if texts and size + len(b) > limit:
            yield batch.slice(start, i - start), texts
            start, size, texts = i, 0, []
        texts.append(b)
        size += len(b)
    if texts:
        yield batch.slice(start, len(texts)), texts


def longs(batch: pa.RecordBatch, column: str):
    """A long column as numpy; null must not occur."""
    return batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)


def emit(schema: pa.Schema, *columns) -> Iterator[pa.RecordBatch]:
    """Record batches of at most OUT_ROWS rows from equally long arrays."""
    n = len(columns[0])
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
              for c, f in zip(columns, schema)]
    for i in range(0, n, OUT_ROWS):
        yield pa.RecordBatch.from_arrays([a.slice(i, OUT_ROWS) for a in arrays], schema=schema)
