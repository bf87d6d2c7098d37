"""Bronze sources: raw CSV ingestion and fixture derivation from the test tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navforge.sources.fixtures import ADAPTER_SQL, SOURCE_TABLES
from navforge.specs import DATASETS, RAW_LINE, DatasetSpec

# CSV options that keep blank-padded cells intact on write (Spark strips them by
# default), so a CSV round trip preserves what the quality rules look at.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


CSV_READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": RAW_LINE,
}
# Cells are counted against all columns, whichever of them a plan reads.
_COUNT_CELLS = {"columnPruning": "false"}


def csv_options(keep_malformed: bool) -> dict[str, str]:
    return CSV_READ_OPTIONS | (_COUNT_CELLS if keep_malformed else {})


def bronze_schema(spec: DatasetSpec) -> T.StructType:
    """Fixed all-text schema of a bronze dataset, in source column order."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in spec.bronze_columns])


def raw_schema(spec: DatasetSpec, keep_malformed: bool = True) -> T.StructType:
    """The bronze schema and, with ``keep_malformed``, the text of lines that do not fit it."""
    schema = bronze_schema(spec)
    return schema.add(RAW_LINE, T.StringType(), True) if keep_malformed else schema


def read_bronze_csv(spark: SparkSession, path: str, spec: DatasetSpec,
                    keep_malformed: bool = False) -> DataFrame:
    """Load raw CSV with a header; every column as text.

    The fixed schema is checked against the header of **every** file: a file whose
    columns are missing, renamed or in another order fails the load instead of
    shifting values into the wrong columns.  No pass is spent on inference.

    With ``keep_malformed`` a line with more or fewer cells than the header keeps its
    text in the further column ``raw_line`` (null for all other lines), which sends it
    to the quarantine; what the parser made of its cells is not used.  Without, missing
    cells are NULL and surplus ones are lost.
    """
    return (spark.read.schema(raw_schema(spec, keep_malformed))
            .options(**csv_options(keep_malformed)).csv(path))


def load_bronze_csv(spark: SparkSession, root: str, datasets: tuple[str, ...] | None = None,
                    keep_malformed: bool = False) -> dict[str, DataFrame]:
    """Raw frames for every dataset from ``<root>/<dataset>`` (a file or a folder)."""
    return {n: read_bronze_csv(spark, f"{root.rstrip('/')}/{n}", DATASETS[n], keep_malformed)
            for n in (datasets or tuple(DATASETS))}


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an input too small to give every core a split (one small file, say).
    Of a larger one Spark's scan makes enough splits by itself, however few its files
    are, so that no large load is shuffled.  Goes by the planner's size of the input:
    no job runs, no file is listed anew."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.repartition(cores) if size < cores * split else df


def write_bronze_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCE_TABLES}


_TABLE_REF = re.compile(r"\b(" + "|".join(SOURCE_TABLES) + r")\b")


def _parametrised(sql: str) -> str:
    return _TABLE_REF.sub(lambda m: "{" + m.group(1) + "}", sql)


def fixture_bronze(spark: SparkSession, sf_dir: str,
                   datasets: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Bronze datasets derived from the parquet tables under ``sf_dir``.

    The SQL is bound to DataFrames (no global temp views are registered).
    """
    tables = source_tables(spark, sf_dir)
    names = datasets or tuple(DATASETS)
    return {n: spark.sql(_parametrised(ADAPTER_SQL[n]), **tables) for n in names}


def row_counts(bronze: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per dataset: one global count each, UNION ALL."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in bronze.items()]
    return reduce(DataFrame.unionAll, parts)
