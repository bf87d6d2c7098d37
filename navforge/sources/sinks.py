"""Table sinks: a lakehouse laid out as ``<root>/<layer>/<table>``.

A table is the folders that a small pointer file names.  Every write, of a batch, of
a stream's micro-batch or of retention, puts its rows into a folder of its own and
then replaces the pointer in one rename: a failed job leaves the table as it was, and
readers see all rows of a write or none.  Overwrite names the new folder only, append
names it beside the others.  The pointer also records

* the last batch of each source, so that a batch which is repeated (a restarted
  stream, a rerun job) adds nothing, whatever was overwritten or aged in between;
* the table's schema, so that reading needs no inference, and rows appended with
  more columns leave the others' as they are (null in the older rows);
* the column by whose values the folders are divided, if any;
* the folder of each named part, for tables whose parts are replaced one by one.

The folders of the pointer before are kept for readers that still use them.  A table
has one writer at a time.  The format is a parameter so a deployment with a table
format on the classpath can switch to it.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_CATALOG_LOCK = threading.Lock()
_POINTER = "_current"


def _hadoop(spark: SparkSession, path: str):
    """(JVM, file system, path) of a path on any file system of Spark."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    p = fs.makeQualified(p)
    return jvm, fs, p


def _nullable(dt: T.DataType) -> T.DataType:
    """The type as a file source reads it back: every level nullable."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True)
                             for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_nullable(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(_nullable(dt.keyType), _nullable(dt.valueType), True)
    return dt


def _merged(before: T.StructType, now: T.StructType) -> T.StructType:
    """All columns of both; a column may not change its type."""
    known = {f.name: f.dataType for f in before}
    for f in now:
        if known.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name}: {known[f.name].simpleString()} in the table, "
                             f"{f.dataType.simpleString()} in the rows to append")
    return T.StructType([*before, *[f for f in now if f.name not in known]])


@dataclass
class Version:
    """What the pointer file holds."""

    folders: list[str]
    schema: dict | None = None
    partition_by: list[str] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)
    parts: dict[str, str] = field(default_factory=dict)


@dataclass
class Lakehouse:
    """``register=True`` also names every written table ``<layer>.<table>`` in the
    session catalog (an external table over its folder, or a view over several), so it
    can be read with ``spark.table`` or SQL.  ``days`` gives the date column of tables,
    by (layer, table), that are divided into a folder for each day."""

    root: str
    fmt: str = "parquet"
    register: bool = False
    days: dict[tuple[str, str], str] = field(default_factory=dict)

    def _root(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def version(self, spark: SparkSession, layer: str, table: str) -> Version | None:
        jvm, fs, path = _hadoop(spark, f"{self._root(layer, table)}/{_POINTER}")
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text)) if text.startswith("{") else Version([text])

    def _publish(self, spark: SparkSession, layer: str, table: str, version: Version,
                 before: Version | None) -> None:
        root = self._root(layer, table)
        jvm, fs, pointer = _hadoop(spark, f"{root}/{_POINTER}")
        new = jvm.org.apache.hadoop.fs.Path(f"{root}/_new-{uuid.uuid4().hex}")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(asdict(version)), "utf-8"))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri())
        overwrite = spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(new, pointer, overwrite)
        used = {*version.folders, *(before.folders if before else [])}
        for status in fs.listStatus(jvm.org.apache.hadoop.fs.Path(root)):
            name = status.getPath().getName()
            if name.startswith("v-") and name not in used:
                fs.delete(status.getPath(), True)
        if self.register:
            self._register(spark, layer, table, version)

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        return self.version(spark, layer, table) is not None

    def paths(self, spark: SparkSession, layer: str, table: str) -> list[str]:
        """The folders of the table as it is now."""
        version = self.version(spark, layer, table)
        if version is None:
            raise FileNotFoundError(f"table {layer}/{table} under {self.root}")
        return [f"{self._root(layer, table)}/{f}" for f in version.folders]

    def layer_bytes(self, spark: SparkSession, layer: str) -> int:
        """Bytes of a layer's tables as they are now."""
        jvm, fs, path = _hadoop(spark, f"{self.root.rstrip('/')}/{layer}")
        if not fs.exists(path):
            return 0
        tables = [s.getPath().getName() for s in fs.listStatus(path)]
        return sum(fs.getContentSummary(jvm.org.apache.hadoop.fs.Path(p)).getLength()
                   for t in tables if self.exists(spark, layer, t)
                   for p in self.paths(spark, layer, t))

    def _save(self, df: DataFrame, layer: str, table: str, partition_by: list[str]) -> str:
        """Rows written to a folder of their own; its name."""
        folder = f"v-{uuid.uuid4().hex}"
        if partition_by:  # each value's rows in files of a fair size, a hot value's in several
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        writer = df.write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{self._root(layer, table)}/{folder}")
        return folder

    def write(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite",
              partition_by: list[str] | None = None, batch: tuple[str, int] | None = None) -> bool:
        """Replace the table's rows or append to them.  ``batch`` (source, number) makes
        the write happen once: if that batch, or a later one of its source, is recorded
        already, nothing is written.  Returns whether rows were written."""
        spark = df.sparkSession
        now = self.version(spark, layer, table)
        if batch and now and now.batches.get(batch[0], -1) >= batch[1]:
            return False
        if partition_by is None:
            day = self.days.get((layer, table))
            partition_by = now.partition_by if now and mode == "append" else [day] if day else []
        folder = self._save(df, layer, table, list(partition_by))
        schema, folders = _nullable(df.schema), [folder]
        if now and mode == "append":
            schema = _merged(self.read(spark, layer, table).schema, schema)
            folders = [*now.folders, folder]
        batches = dict(now.batches if now else {})
        if batch:
            batches[batch[0]] = batch[1]
        parts = now.parts if now and mode == "append" else {}
        self._publish(spark, layer, table, Version(folders, json.loads(schema.json()),
                                                   list(partition_by), batches, parts), now)
        return True

    def save_parts(self, rows: dict[str, DataFrame], layer: str, table: str
                   ) -> tuple[Version, Version | None]:
        """Write the named parts of a table, one folder each, without publishing them;
        give the result to ``publish_parts``."""
        spark = next(iter(rows.values())).sparkSession
        now = self.version(spark, layer, table)
        day = self.days.get((layer, table))
        partition_by = now.partition_by if now else [day] if day else []
        schema = self.read(spark, layer, table).schema if now else T.StructType()
        parts = dict(now.parts if now else {})
        replaced = {parts[name] for name in rows if name in parts}
        for name, df in rows.items():
            parts[name] = self._save(df, layer, table, partition_by)
            schema = _merged(schema, _nullable(df.schema))
        folders = [f for f in (now.folders if now else []) if f not in replaced]
        folders += [parts[name] for name in rows]
        return Version(folders, json.loads(schema.json()), partition_by,
                       now.batches if now else {}, parts), now

    def publish_parts(self, spark: SparkSession, layer: str, table: str,
                      saved: tuple[Version, Version | None]) -> None:
        self._publish(spark, layer, table, *saved)

    def write_parts(self, rows: dict[str, DataFrame], layer: str, table: str) -> None:
        """Replace the named parts of a table, or add them: all are published by one
        rename.  Other parts stay as they are, so writing a part again changes nothing
        else.  Overwriting or compacting the table ends its parts."""
        spark = next(iter(rows.values())).sparkSession
        self.publish_parts(spark, layer, table, self.save_parts(rows, layer, table))

    def read_part(self, spark: SparkSession, layer: str, table: str, part: str,
                  version: Version | None = None) -> DataFrame:
        """The rows of one named part, of a version that may not be published yet."""
        now = version or self.version(spark, layer, table)
        return self._load(spark, now, [f"{self._root(layer, table)}/{now.parts[part]}"])

    def compact(self, spark: SparkSession, layer: str, table: str) -> None:
        """Rewrite a table of many appended folders as one."""
        if len(self.paths(spark, layer, table)) > 1:
            self.write(self.read(spark, layer, table), layer, table,
                       partition_by=self.version(spark, layer, table).partition_by)

    def delete_where(self, spark: SparkSession, layer: str, table: str, gone: Column) -> int:
        """Delete the rows for which ``gone`` is true; only folders that hold such rows
        are rewritten (null: stays).  Returns the number of folders touched."""
        now = self.version(spark, layer, table)
        gone = F.coalesce(gone, F.lit(False))
        folders, parts, touched = [], dict(now.parts), 0
        for folder in now.folders:
            rows = self._load(spark, now, [f"{self._root(layer, table)}/{folder}"])
            if rows.where(gone).isEmpty():
                folders.append(folder)
                continue
            touched += 1
            folders.append(self._save(rows.where(~gone), layer, table, now.partition_by))
            parts.update({name: folders[-1] for name, f in now.parts.items() if f == folder})
        if touched:
            schema = now.schema or json.loads(self.read(spark, layer, table).schema.json())
            self._publish(spark, layer, table, Version(folders, schema, now.partition_by,
                                                       now.batches, parts), now)
        return touched

    def drop_days(self, spark: SparkSession, layer: str, table: str, before: dt.date) -> list[str]:
        """Delete the days before a date of a table divided by day: whole folders, without
        reading or writing a row.  Returns their names."""
        now, out = self.version(spark, layer, table), []
        [column] = now.partition_by
        for path in self.paths(spark, layer, table):
            jvm, fs, folder = _hadoop(spark, path)
            for status in fs.listStatus(folder):
                name, _, value = status.getPath().getName().partition("=")
                if name == column and value[:1].isdigit() and value < before.isoformat():
                    fs.delete(status.getPath(), True)
                    out.append(value)
        return sorted(set(out))

    def replace_days(self, df: DataFrame, layer: str, table: str) -> None:
        """Replace the days that ``df`` holds rows of, by Spark's dynamic partition
        overwrite; all other days' files stay as they are."""
        spark = df.sparkSession
        self.compact(spark, layer, table)
        now = self.version(spark, layer, table)
        [path] = self.paths(spark, layer, table)
        (df.hint("rebalance", *[F.col(c) for c in now.partition_by]).write.format(self.fmt)
         .mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*now.partition_by).save(path))

    def _register(self, spark: SparkSession, layer: str, table: str, version: Version) -> None:
        # Re-created on every write: an overwrite may change the schema.  Dropping an
        # external table leaves its files alone.
        name = f"`{layer}`.`{table}`"
        paths = [f"{self._root(layer, table)}/{f}" for f in version.folders]
        with _CATALOG_LOCK:  # steps of one wave write (and register) concurrently
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
            if spark.catalog.tableExists(f"{layer}.{table}"):
                view = spark.catalog.getTable(f"{layer}.{table}").tableType == "VIEW"
                spark.sql(f"DROP {'VIEW' if view else 'TABLE'} {name}")
            if len(paths) == 1:
                spark.sql(f"CREATE TABLE {name} USING {self.fmt} "
                          f"LOCATION '{paths[0].replace(chr(39), chr(39) * 2)}'")
                if version.partition_by:
                    spark.sql(f"MSCK REPAIR TABLE {name}")
            else:
                columns = ", ".join(f"`{f['name']}`" for f in version.schema["fields"])
                spark.sql(f"CREATE VIEW {name} AS " + " UNION ALL ".join(
                    f"SELECT {columns} FROM {self.fmt}.`{p}`" for p in paths))

    def _load(self, spark: SparkSession, version: Version, paths: list[str]) -> DataFrame:
        if version.partition_by and len(paths) > 1:  # each folder is divided by itself
            return reduce(DataFrame.unionByName, [self._load(spark, version, [p]) for p in paths])
        reader = spark.read.format(self.fmt)
        if version.schema:
            schema = T.StructType.fromJson(version.schema)
            return reader.schema(schema).load(paths).select(schema.names)
        return reader.load(paths)

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return self._load(spark, self.version(spark, layer, table) or Version([]),
                          self.paths(spark, layer, table))
