"""End-to-end batch run: bronze -> silver -> gold -> ops, every layer written.

Tables are the hand-over between steps (as in a scheduled lakehouse job), so
each step reads its inputs from storage with file statistics, and a lost
executor only costs the current step.  Layout and table names:

    bronze/<dataset>                      raw text rows
    silver/<dataset>                      valid rows
    ops/dq_<dataset>_quarantine           rows with issues + the codes
    ops/dq_metrics                        appended once per dataset per run
    gold/fund_nav_daily, investor_positions, fund_cashflows,
         asset_allocation, api_fund_summary
    ops/dq_issue_summary, dq_latest_summary, pipeline_health
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from navforge.operators import gold, ops
from navforge.operators.quality import (
    ISSUES, prepare_reference, quarantine_rows, valid_rows, validate,
)
from navforge.operators.reports import aged, record_publications, retention_cutoff
from navforge.session import ensure_checkpoint_dir, size_shuffles
from navforge.sources.bronze import spread
from navforge.sources.sinks import Lakehouse
from navforge.sources.staging import release_staged, staged
from navforge.specs import DATASETS, DIMENSIONS
from navforge.streaming.ingest import ingest_table


def run_timestamp(now: dt.datetime | None = None) -> Column:
    """One audit timestamp for the whole run, so every table of a run agrees."""
    return F.lit(now or dt.datetime.now()).cast("timestamp")


class Timer:
    """Runs pipeline steps, alone or as a wave of independent steps.

    Steps of one wave are submitted from ``workers`` threads; Spark schedules
    their jobs side by side, so one step's driver-side planning and small
    stages overlap another's tasks.  Each step deletes the tables that it staged
    (tracked per thread) when it ends.
    """

    def __init__(self, workers: int = 1) -> None:
        self.steps: dict[str, float] = {}
        self.workers = max(1, workers)

    def __call__(self, name: str, fn: Callable[[], object]) -> object:
        t0 = time.perf_counter()
        try:
            return fn()
        finally:
            release_staged()
            if not name.startswith("_"):  # "_name": a group whose steps time themselves
                self.steps[name] = round(time.perf_counter() - t0, 3)

    def wave(self, steps: dict[str, Callable[[], object]]) -> None:
        if self.workers == 1 or len(steps) == 1:
            for name, fn in steps.items():
                self(name, fn)
            return
        with ThreadPoolExecutor(max_workers=min(self.workers, len(steps))) as pool:
            futures = [pool.submit(self, name, fn) for name, fn in steps.items()]
            for f in futures:
                f.result()  # re-raise the first failure


def ingest_bronze(lake: Lakehouse, bronze: dict[str, DataFrame], timer: Timer | None = None) -> None:
    timer = timer or Timer()
    timer.wave({f"bronze_{name}": (lambda df=df, name=name: lake.write(spread(df), "bronze", name))
                for name, df in bronze.items()})


def ingest_bronze_incremental(spark: SparkSession, lake: Lakehouse, raw_root: str,
                              checkpoint_root: str, timer: Timer | None = None) -> None:
    """Append to ``bronze/<dataset>`` the raw files of ``<raw_root>/<dataset>/`` not
    loaded before (file stream, available-now trigger, one checkpoint per dataset
    under ``checkpoint_root``, which must be shared storage on a cluster).  Retention
    and other overwrites of the tables may come between two calls."""
    timer = timer or Timer()
    root, ckpt = raw_root.rstrip("/"), checkpoint_root.rstrip("/")
    timer.wave({f"bronze_{n}": (lambda n=n, spec=spec: ingest_table(
        spark, f"{root}/{n}", spec, lake, f"{ckpt}/{n}"))
        for n, spec in DATASETS.items()})


def _materialize(df: DataFrame, mode: str) -> DataFrame:
    """How the validated frame is shared by its two split writes.

    ``staged``: written once to the shared folder, partitioned by validity, so each
    split reads its own rows only; nothing is kept on executors.  ``checkpoint``:
    the same by ``DataFrame.checkpoint``.  ``recompute``: nothing kept, each split
    validates anew (two scans).
    """
    if mode == "staged":
        return staged(df.withColumn("__valid", F.size(ISSUES) == 0), "validated", "__valid")
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if mode == "recompute":
        return df
    raise ValueError(f"unknown materialize mode {mode!r}")


def _split(df: DataFrame, valid: bool) -> DataFrame:
    return df.where(F.col("__valid") == valid).drop("__valid") if "__valid" in df.columns else df


def build_silver(spark: SparkSession, lake: Lakehouse, run_ts: Column, dedupe_refs: bool = True,
                 timer: Timer | None = None, materialize: str = "staged",
                 run_id: str | None = None) -> dict[str, dict[str, int]]:
    """Validate each dataset once; write the valid and the quarantine split, then
    append one metrics row per dataset.  Returns, by dataset, how many rows and rows
    with each code were written: counted by the job that writes the validated rows
    (not where ``materialize`` is ``recompute``, which has no such job).  References are read from silver tables
    written in this run: funds and investors form the first wave, the datasets
    referencing them the second."""
    timer = timer or Timer()
    counts: dict[str, dict[str, int]] = {}

    def step(name: str, refs: dict[str, DataFrame]) -> Callable[[], None]:
        spec = DATASETS[name]

        def run_step() -> None:
            bronze = lake.read(spark, "bronze", name)
            validated = validate(bronze, spec, refs, dedupe_refs, prepared=True)
            if materialize != "recompute":
                seen = Observation()
                validated = validated.observe(seen, *ops.observed_counts(validated, spec))
            shared = _materialize(validated, materialize)
            if materialize != "recompute":
                counts[name] = seen.get
            lake.write(valid_rows(_split(shared, True), spec, run_ts), "silver", name)
            lake.write(quarantine_rows(_split(shared, False), run_ts), "ops",
                       f"dq_{name}_quarantine")
        return run_step

    referenced = {r.dataset for spec in DATASETS.values() for r in spec.references}
    first = [n for n in DATASETS if not DATASETS[n].references]
    second = [n for n in DATASETS if DATASETS[n].references]
    timer.wave({f"silver_{n}": step(n, {}) for n in first})
    # valid ids of each referenced dataset, size-checked once for the whole wave
    prepared = {d: prepare_reference(lake.read(spark, "silver", d), dedupe_refs)
                for d in sorted(referenced)}
    timer.wave({f"silver_{n}": step(n, prepared) for n in second})

    def metrics_row(n: str) -> DataFrame:
        bronze = lake.read(spark, "bronze", n)
        if n in counts:  # without fan-out the validated rows are the raw ones
            total = counts[n]["rows"] if dedupe_refs else bronze.count()
            return ops.dq_metrics_observed(spark, n, total, counts[n], run_ts)
        return ops.dq_metrics_written(n, bronze, lake.read(spark, "silver", n),
                                      lake.read(spark, "ops", f"dq_{n}_quarantine"), run_ts)

    # One append for the run: a metrics row per dataset.
    metrics = reduce(DataFrame.unionByName, [metrics_row(n) for n in DATASETS])
    timer("dq_metrics", lambda: lake.write(
        metrics, "ops", "dq_metrics", mode="append", batch=(f"run-{run_id}", 0) if run_id else None))
    return counts


def build_gold(spark: SparkSession, lake: Lakehouse, run_ts: Column,
               timer: Timer | None = None) -> None:
    timer = timer or Timer()
    silver = {n: lake.read(spark, "silver", n) for n in DATASETS}
    funds, positions, transactions = silver["funds"], silver["positions"], silver["transactions"]
    # Dimensions are size-checked once for the whole layer.
    dims = {n: gold.dimension(silver[n], n) for n in DIMENSIONS}
    timer.wave({
        "fund_nav_daily": lambda: lake.write(
            gold.fund_nav_daily(positions, dims["funds"], run_ts), "gold", "fund_nav_daily"),
        "investor_positions": lambda: lake.write(
            gold.investor_positions(positions, dims["funds"], dims["investors"], run_ts),
            "gold", "investor_positions"),
        "fund_cashflows": lambda: lake.write(
            gold.fund_cashflows(transactions, dims["funds"], run_ts), "gold", "fund_cashflows"),
        "asset_allocation": lambda: lake.write(
            gold.asset_allocation(positions, dims["funds"], run_ts), "gold", "asset_allocation"),
    })
    # The summary starts from the NAV table just written, not a recomputation.
    timer("api_fund_summary", lambda: lake.write(
        gold.api_fund_summary(funds, lake.read(spark, "gold", "fund_nav_daily"), transactions,
                              run_ts), "gold", "api_fund_summary"))


def record_publication(spark: SparkSession, lake: Lakehouse, run_ts: Column) -> None:
    """Keep ops/nav_publications: the first publication of each valuation date."""
    known = lake.read(spark, "ops", "nav_publications") \
        if lake.exists(spark, "ops", "nav_publications") else None
    lake.write(record_publications(lake.read(spark, "gold", "fund_nav_daily"), run_ts, known),
               "ops", "nav_publications")


#: Date column that retention goes by, for each aged table.
AGED = {
    "bronze": {"transactions": "transaction_date", "positions": "valuation_date",
               "market_prices": "price_date"},
    "silver": {"transactions": "transaction_date", "positions": "valuation_date",
               "market_prices": "price_date"},
    "gold": {"fund_nav_daily": "valuation_date", "investor_positions": "valuation_date",
             "fund_cashflows": "transaction_date", "asset_allocation": "valuation_date"},
    "ops": {"dq_metrics": "execution_date"},
}


#: Fact tables to divide by day: ``Lakehouse(root, days=DAYS)``.
DAYS = {(layer, table): column for layer in ("silver", "gold")
        for table, column in AGED[layer].items()}


def retain(spark: SparkSession, lake: Lakehouse, as_of: dt.date) -> dict[str, int]:
    """Delete from every aged table of all four layers what its layer's retention window
    has left (raw dates that do not parse cannot age and stay).

    A table divided by day loses the folders of its aged days, and nothing is read or
    written.  Of another table only the folders that hold aged rows are rewritten; one
    without any is left alone.  Returns the days or folders touched by table."""
    out = {}
    for layer, tables in AGED.items():
        cutoff = spark.range(1).select(retention_cutoff(F.lit(as_of), layer)).first()[0]
        for table, column in tables.items():
            if lake.version(spark, layer, table).partition_by == [column]:
                touched = len(lake.drop_days(spark, layer, table, cutoff))
            else:
                gone = aged(lake.read(spark, layer, table), column, layer, F.lit(as_of))
                touched = lake.delete_where(spark, layer, table, gone)
            out[f"{layer}/{table}"] = touched
    return out


def refresh_gold(spark: SparkSession, lake: Lakehouse, run_ts: Column,
                 positions: DataFrame | None = None,
                 transactions: DataFrame | None = None,
                 timer: Timer | None = None) -> dict[str, list[dt.date]]:
    """Bring the gold facts up to date after rows of some days have come, gone or changed.

    ``positions`` and ``transactions`` are those silver rows (their day suffices).  Only
    these days of the silver facts are read, by partition, and only these days of the
    gold facts replaced; the summary is then made from the facts.  The tables must be
    divided by day (``Lakehouse(root, days=DAYS)``).  Equals a full ``build_gold`` as
    long as the dimensions are the same.  Returns the days by silver table."""
    changed = {"positions": positions, "transactions": transactions}
    days = {n: sorted(r[0] for r in df.select(AGED["silver"][n]).distinct().collect())
            for n, df in changed.items() if df is not None}  # as many rows as days
    silver = {n: lake.read(spark, "silver", n) for n in DATASETS}
    part = {n: silver[n].where(F.col(AGED["silver"][n]).isin(d)) for n, d in days.items() if d}
    # Days of which no silver row is left
    gone = {}
    for n, kept in part.items():
        left = {r[0] for r in kept.select(AGED["silver"][n]).distinct().collect()}
        gone[n] = [d for d in days[n] if d not in left]
    funds = gold.dimension(silver["funds"], "funds")

    def step(table: str, n: str, make: Callable[[], DataFrame]) -> Callable[[], None]:
        def run_step() -> None:
            lake.replace_days(make(), "gold", table)
            _empty_days(spark, lake, table, gone[n])
        return run_step

    steps = {}
    if "positions" in part:
        rows, investors = part["positions"], gold.dimension(silver["investors"], "investors")
        steps = {
            "fund_nav_daily": step("fund_nav_daily", "positions", lambda: gold.fund_nav_daily(
                rows, funds, run_ts)),
            "investor_positions": step("investor_positions", "positions", lambda:
                                       gold.investor_positions(rows, funds, investors, run_ts)),
            "asset_allocation": step("asset_allocation", "positions", lambda:
                                     gold.asset_allocation(rows, funds, run_ts))}
    if "transactions" in part:
        steps["fund_cashflows"] = step("fund_cashflows", "transactions", lambda:
                                       gold.fund_cashflows(part["transactions"], funds, run_ts))
    if steps:
        (timer or Timer()).wave(steps)
    if part:
        lake.write(gold.api_fund_summary(
            silver["funds"], lake.read(spark, "gold", "fund_nav_daily"), silver["transactions"],
            run_ts), "gold", "api_fund_summary")
    return days


def _empty_days(spark: SparkSession, lake: Lakehouse, table: str, gone: list[dt.date]) -> None:
    """Days of which no silver row is left go from a gold table too."""
    if gone:
        lake.delete_where(spark, "gold", table, F.col(AGED["gold"][table]).isin(gone))


def build_ops(spark: SparkSession, lake: Lakehouse, timer: Timer | None = None,
              counts: dict[str, dict[str, int]] | None = None) -> None:
    """``counts``: those that ``build_silver`` returns; without them the quarantine
    tables are read for the issue summary."""
    timer = timer or Timer()

    def issue_summary() -> DataFrame:
        if counts and set(counts) == set(DATASETS):
            return ops.dq_issue_summary_observed(spark, counts)
        return ops.dq_issue_summary({n: lake.read(spark, "ops", f"dq_{n}_quarantine")
                                     for n in DATASETS})

    def latest_then_health() -> None:  # health reads the latest summary just written
        timer("dq_latest_summary", lambda: lake.write(
            ops.dq_latest_summary(lake.read(spark, "ops", "dq_metrics")), "ops",
            "dq_latest_summary"))
        timer("pipeline_health", lambda: lake.write(
            ops.pipeline_health(lake.read(spark, "ops", "dq_latest_summary")), "ops",
            "pipeline_health"))

    timer.wave({
        "dq_issue_summary": lambda: lake.write(
            issue_summary(), "ops", "dq_issue_summary"),
        "_latest_then_health": latest_then_health,
    })


def run(spark: SparkSession, lake: Lakehouse, bronze: dict[str, DataFrame] | None = None,
        run_ts: Column | None = None, dedupe_refs: bool = True,
        materialize: str = "staged", workers: int = 4,
        run_id: str | None = None) -> dict[str, float]:
    """Run every layer; ``bronze`` (dataset -> raw frame) is ingested first when
    given, else the bronze tables already in ``lake`` are used.  Independent
    steps run ``workers`` at a time (1 = one after another).  A run that is repeated
    under its ``run_id`` adds no second set of metrics.  Returns the seconds spent per
    step."""
    timer = Timer(workers)
    run_ts = run_ts if run_ts is not None else run_timestamp()
    if bronze is not None:
        ingest_bronze(lake, bronze, timer)
    # Shuffles sized to the raw data, never below what the session is set to.
    size_shuffles(spark, lake.layer_bytes(spark, "bronze"), min_partitions=int(
        spark.conf.get("spark.sql.shuffle.partitions")))
    counts = build_silver(spark, lake, run_ts, dedupe_refs, timer, materialize, run_id)
    build_gold(spark, lake, run_ts, timer)
    record_publication(spark, lake, run_ts)
    build_ops(spark, lake, timer, counts)
    return timer.steps


def bronze_row_counts(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    parts = [lake.read(spark, "bronze", n).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in DATASETS]
    return reduce(DataFrame.unionAll, parts)
