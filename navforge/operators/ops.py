"""Ops-layer operators: quality metrics, issue summary, latest metrics, health."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navforge.operators.quality import ISSUES
from navforge.specs import (
    HEALTH_FALLBACK, HEALTH_THRESHOLDS, MALFORMED_LINE, RAW_LINE, DatasetSpec,
)


def dq_metrics(dataset: str, bronze: DataFrame, validated: DataFrame,
               run_ts: Column | None = None) -> DataFrame:
    """One metrics row for a dataset, computed by one aggregate job.

    ``total_records`` counts bronze rows; valid/invalid count the split of the
    validated rows.  Both inputs are tagged and unioned, so a single shuffle-free
    global aggregate produces the row (no driver-side counting, no cross join).
    ``dq_score`` is ``round(valid / total * 100, 2)``; NULL for empty input.
    """
    tagged = reduce(DataFrame.unionByName, [
        bronze.select(F.lit(True).alias("_bronze"), F.lit(None).cast("int").alias("_n")),
        validated.select(F.lit(False).alias("_bronze"), F.size(ISSUES).alias("_n")),
    ])
    counts = tagged.agg(
        F.count_if(F.col("_bronze")).alias("total_records"),
        F.count_if(~F.col("_bronze") & (F.col("_n") == 0)).alias("valid_records"),
        F.count_if(~F.col("_bronze") & (F.col("_n") > 0)).alias("invalid_records"),
    )
    return _metrics_row(counts, dataset, run_ts)


def _metrics_row(counts: DataFrame, dataset: str, run_ts: Column | None) -> DataFrame:
    score = F.round(F.try_divide(F.col("valid_records"), F.col("total_records")) * 100, 2)
    out = counts.select(F.lit(dataset).alias("dataset"), "total_records", "valid_records",
                        "invalid_records", score.cast("double").alias("dq_score"))
    if run_ts is not None:
        out = out.withColumn("execution_date", run_ts)
    return out


def observed_counts(validated: DataFrame, spec: DatasetSpec) -> list[Column]:
    """Aggregates for ``DataFrame.observe`` on validated rows: all rows (``rows``), those
    without issues (``valid``), and those with each code."""
    codes = [r.code for r in spec.rules] + [MALFORMED_LINE] * (RAW_LINE in validated.columns)
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(ISSUES) == 0).alias("valid"),
            *[F.count_if(F.array_contains(ISSUES, c)).alias(c) for c in codes]]


def dq_metrics_observed(spark: SparkSession, dataset: str, total: int, counts: dict[str, int],
                        run_ts: Column | None = None) -> DataFrame:
    """Metrics row from counts observed while the rows were written."""
    one = spark.createDataFrame(
        [(total, counts["valid"], counts["rows"] - counts["valid"])],
        "total_records long, valid_records long, invalid_records long")
    return _metrics_row(one, dataset, run_ts)


def dq_issue_summary_observed(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """The issue summary from the datasets' observed counts (a row for each code that occurs)."""
    rows = [(name, code, n) for name, found in counts.items() for code, n in found.items()
            if n and code not in ("rows", "valid")]
    return spark.createDataFrame(rows, "dataset string, dq_issue string, issue_count long")


def dq_metrics_written(dataset: str, bronze: DataFrame, valid: DataFrame,
                       quarantine: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Metrics row from the tables as written (bronze, silver, quarantine).

    Counting written Parquet tables reads only footers, so this costs almost
    nothing and reports exactly what consumers will see.
    """
    tagged = reduce(DataFrame.unionByName, [
        bronze.select(F.lit(0).alias("_part")),
        valid.select(F.lit(1).alias("_part")),
        quarantine.select(F.lit(2).alias("_part")),
    ])
    counts = tagged.agg(
        F.count_if(F.col("_part") == 0).alias("total_records"),
        F.count_if(F.col("_part") == 1).alias("valid_records"),
        F.count_if(F.col("_part") == 2).alias("invalid_records"),
    )
    return _metrics_row(counts, dataset, run_ts)


def dq_issue_summary(quarantines: dict[str, DataFrame]) -> DataFrame:
    """Rows per (dataset, issue code) across all quarantine tables.

    Datasets are unioned first (only the tag and the issue array are read),
    then exploded and counted in **one** aggregate: one shuffle of partial
    counts instead of one per dataset.
    """
    tagged = reduce(DataFrame.unionByName, [
        q.select(F.lit(name).alias("dataset"), F.col(ISSUES)) for name, q in quarantines.items()
    ])
    return (tagged.select("dataset", F.explode(ISSUES).alias("dq_issue"))
            .groupBy("dataset", "dq_issue")
            .agg(F.count(F.lit(1)).alias("issue_count")))


def dq_latest_summary(metrics: DataFrame) -> DataFrame:
    """Newest metrics row per dataset.

    Ties on ``execution_date`` are broken on the metric values so the choice
    is deterministic.  Spark plans ``row_number() = 1`` with a partial
    WindowGroupLimit before the shuffle, so each task ships one row per dataset.
    """
    order = [F.col("execution_date").desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in metrics.columns
              if c not in ("dataset", "execution_date")]
    w = Window.partitionBy("dataset").orderBy(*order)
    return (metrics.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .drop("_rn"))


def health_status(score: Column) -> Column:
    expr = None
    for bound, label in HEALTH_THRESHOLDS:
        expr = F.when(score >= bound, label) if expr is None else expr.when(score >= bound, label)
    return expr.otherwise(HEALTH_FALLBACK)


def pipeline_health(latest: DataFrame) -> DataFrame:
    """Latest metrics + Healthy / Warning / Critical (NULL score is Critical)."""
    return latest.withColumn("health_status", health_status(F.col("dq_score")))


def rule_health(dataset: str, validated: DataFrame, codes: list[str]) -> DataFrame:
    """Share of rows that pass each rule, with the health label of that score:
    (dataset, dq_issue, passed_records, dq_score, health_status).  One aggregate."""
    failed = [F.count_if(F.array_contains(ISSUES, c)) for c in codes]
    counted = validated.agg(F.count(F.lit(1)).alias("n"), F.array(*failed).alias("failed"))
    rows = counted.select("n", F.explode(F.arrays_zip(
        "failed", F.array(*[F.lit(c) for c in codes]).alias("code"))).alias("x"))
    passed = F.col("n") - F.col("x.failed")
    score = F.round(F.try_divide(passed, F.col("n")) * 100, 2).cast("double")
    return pipeline_health(rows.select(
        F.lit(dataset).alias("dataset"), F.col("x.code").alias("dq_issue"),
        passed.alias("passed_records"), score.alias("dq_score")))
