"""The whole pipeline as one lazy chain of DataFrames for a given input folder.

``Chain`` is what the registered queries use: bronze fixtures derived from the
tables in ``sf_dir``, validated silver frames, gold and ops frames.  Frames are
built on first use and shared by later steps of the same chain; nothing is
written.  (The production entry point that writes every layer is
:mod:`navforge.plans.pipeline`.)
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navforge.operators import gold, ops
from navforge.operators.joins import SizedSide
from navforge.operators.quality import (
    ISSUES, prepare_reference, quarantine_rows, valid_rows, validate,
)
from navforge.sources.bronze import fixture_bronze
from navforge.specs import DATASETS


class Chain:
    def __init__(self, spark: SparkSession, sf_dir: str, dedupe_refs: bool = True,
                 measured: bool = True, run_ts: Column | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.dedupe_refs = dedupe_refs
        self.measured = measured
        self.run_ts = run_ts
        self._validated: dict[str, DataFrame] = {}
        self._refs: dict[str, SizedSide] = {}
        self._dims: dict[str, SizedSide] = {}

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return fixture_bronze(self.spark, self.sf_dir)

    def reference(self, name: str) -> SizedSide:
        """Valid ids of ``name``, prepared (and size-checked) once per chain."""
        if name not in self._refs:
            self._refs[name] = prepare_reference(self.silver(name), self.dedupe_refs,
                                                 self.measured)
        return self._refs[name]

    def validated(self, name: str) -> DataFrame:
        if name not in self._validated:
            spec = DATASETS[name]
            refs = {r.dataset: self.reference(r.dataset) for r in spec.references}
            self._validated[name] = validate(self.bronze[name], spec, refs, self.dedupe_refs,
                                             self.measured, prepared=True)
        return self._validated[name]

    def silver(self, name: str) -> DataFrame:
        return valid_rows(self.validated(name), DATASETS[name])

    def quarantine(self, name: str) -> DataFrame:
        return quarantine_rows(self.validated(name))

    # -- gold ---------------------------------------------------------------
    def dim(self, name: str) -> SizedSide:
        """Dimension of a silver table, size-checked once per chain."""
        if name not in self._dims:
            self._dims[name] = gold.dimension(self.silver(name), name, self.measured)
        return self._dims[name]

    @cached_property
    def fund_nav_daily(self) -> DataFrame:
        return gold.fund_nav_daily(self.silver("positions"), self.dim("funds"))

    @cached_property
    def investor_positions(self) -> DataFrame:
        return gold.investor_positions(self.silver("positions"), self.dim("funds"),
                                       self.dim("investors"))

    @cached_property
    def fund_cashflows(self) -> DataFrame:
        return gold.fund_cashflows(self.silver("transactions"), self.dim("funds"))

    @cached_property
    def asset_allocation(self) -> DataFrame:
        return gold.asset_allocation(self.silver("positions"), self.dim("funds"))

    @cached_property
    def latest_nav(self) -> DataFrame:
        return gold.latest_nav(self.fund_nav_daily)

    @cached_property
    def latest_cashflow_date(self) -> DataFrame:
        return gold.latest_cashflow_date(self.silver("transactions"))

    @cached_property
    def api_fund_summary(self) -> DataFrame:
        return gold.api_fund_summary(self.silver("funds"), self.fund_nav_daily,
                                     self.silver("transactions"))

    # -- ops ----------------------------------------------------------------
    @cached_property
    def dq_metrics(self) -> DataFrame:
        run_ts = self.run_ts if self.run_ts is not None else F.current_timestamp()
        parts = [ops.dq_metrics(n, self.bronze[n], self.validated(n), run_ts) for n in DATASETS]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    @cached_property
    def dq_issue_summary(self) -> DataFrame:
        return ops.dq_issue_summary({n: self.quarantine(n) for n in DATASETS})

    @cached_property
    def dq_latest_summary(self) -> DataFrame:
        return ops.dq_latest_summary(self.dq_metrics)

    @cached_property
    def pipeline_health(self) -> DataFrame:
        return ops.pipeline_health(self.dq_latest_summary)


def issues_as_text(df: DataFrame) -> DataFrame:
    """Comma-joined issue codes (engine-neutral form for comparisons)."""
    return df.withColumn(ISSUES, F.array_join(F.col(ISSUES), ","))
