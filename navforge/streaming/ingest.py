"""Incremental bronze ingestion with Structured Streaming.

Loading raw files "once each" (new files are appended, files already loaded
are skipped, re-running is harmless) is what a file-source stream with a
checkpoint gives: the source's file log remembers every file it committed.
``trigger(availableNow=True)`` processes everything present now in bounded
micro-batches and stops, so the job runs as a scheduled batch while keeping
exactly-once file bookkeeping across runs and restarts.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from navforge.sources.bronze import csv_options, raw_schema
from navforge.sources.sinks import Lakehouse
from navforge.specs import DatasetSpec

MAX_FILES_PER_TRIGGER = 1000


def stream_bronze_csv(spark: SparkSession, source_dir: str, spec: DatasetSpec,
                      keep_malformed: bool = False):
    """A streaming DataFrame of the raw CSV files under ``source_dir``.

    Streams need the schema up front: the fixed all-text bronze schema, with
    the header checked against it (``enforceSchema=false``) so a file whose
    columns differ fails instead of shifting values.  ``keep_malformed`` as in
    :func:`~navforge.sources.bronze.read_bronze_csv`.
    """
    return (spark.readStream.schema(raw_schema(spec, keep_malformed))
            .options(**csv_options(keep_malformed))
            .option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
            .csv(source_dir))


def ingest_table(spark: SparkSession, source_dir: str, spec: DatasetSpec, lake: Lakehouse,
                 checkpoint: str, layer: str = "bronze") -> int:
    """Append rows of files not loaded before, malformed lines kept as text, to a table of
    ``lake``; returns rows added.

    Each micro-batch is a write of the lakehouse that records the stream's id and the
    batch's number.  A batch that a restarted stream repeats, because it ended between
    the table's write and the stream's own commit, adds nothing; and as the record
    belongs to the table, overwrites and retention in between do not disturb it.  The
    stream's id lives in its checkpoint: with a new checkpoint all files are new.
    """
    added: list[int] = []
    known, ids = threading.Event(), []

    def load(batch: DataFrame, number: int) -> None:
        known.wait()
        rows = Observation()
        counted = batch.observe(rows, F.count(F.lit(1)).alias("n"))
        if lake.write(counted, layer, spec.name, mode="append", batch=(ids[0], number)):
            added.append(rows.get["n"])

    query = (stream_bronze_csv(spark, source_dir, spec, True).writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    ids.append(f"stream-{query.id}")
    known.set()
    query.awaitTermination()
    if not lake.exists(spark, layer, spec.name):  # no file yet: an empty table
        lake.write(spark.createDataFrame([], raw_schema(spec)), layer, spec.name)
    return sum(added)


def ingest_new_files(spark: SparkSession, source_dir: str, spec: DatasetSpec, target: str,
                     checkpoint: str, fmt: str = "parquet") -> int:
    """Append rows of files not loaded before to the plain folder ``target``, by Spark's
    own file sink; returns rows added.  (Tables of a lakehouse: :func:`ingest_table`.)"""
    query = (stream_bronze_csv(spark, source_dir, spec).writeStream
             .format(fmt)
             .outputMode("append")
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start(target))
    # The query remembers its last 100 batches only, so they are gathered as it runs.
    rows: dict[int, int] = {}
    active = True
    while active:
        active = not query.awaitTermination(1)
        rows.update((p["batchId"], int(p["numInputRows"] or 0)) for p in query.recentProgress)
    if query.exception() is not None:
        raise query.exception()
    return sum(rows.values())
