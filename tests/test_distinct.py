"""Sets of investors that merge, and counts observed while rows are written."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from navforge.operators import distinct, ops
from navforge.plans import pipeline
from navforge.sources.bronze import fixture_bronze
from navforge.sources.sinks import Lakehouse
from navforge.specs import DATASETS
from tests.conftest import SF_SMALL


def test_sets_of_two_loads_merge_to_exact_counts(spark, scratch):
    rng = random.Random(1)
    # One fund and one investor hold a large part of the rows.
    rows = [(rng.choice(["F1"] * 4 + ["F2", "F3"]), f"2024-01-{rng.randint(1, 28):02}", "EUR",
             rng.choice([None, "I1", "I1", f"I{rng.randint(1, 900)}"])) for _ in range(6000)]
    df = spark.createDataFrame(rows, "fund_id string, valuation_date string, currency string, "
                                     "investor_id string").repartition(7)
    lake = Lakehouse(f"{scratch}/lake")
    for part in (df.where("valuation_date < '2024-01-11'"), df.where("valuation_date >= '2024-01-11'")):
        known = lake.read(spark, "g", "codes") if lake.exists(spark, "g", "codes") else None
        lake.write(distinct.number_ids(part, known=known), "g", "codes", "append")
        lake.write(distinct.daily_sets(part, lake.read(spark, "g", "codes")), "g", "sets", "append")
    codes = lake.read(spark, "g", "codes")
    assert codes.count() == codes.select("code").distinct().count() == \
        codes.select("investor_id").distinct().count() == len({r[3] for r in rows} - {None})
    sets = lake.read(spark, "g", "sets")
    for a, b in (("2024-01-01", "2024-01-31"), ("2024-01-08", "2024-01-14"), ("2024-01-20", "2024-01-20")):
        got = {r.fund_id: r.investor_count for r in distinct.distinct_ids(
            sets.where(F.col("valuation_date").between(a, b)), ["fund_id"]).collect()}
        want = {f: len({r[3] for r in rows if r[0] == f and a <= r[1] <= b} - {None})
                for f in ("F1", "F2", "F3")}
        assert got == {f: n for f, n in want.items() if n}
    assert distinct.distinct_ids(sets.limit(0), ["fund_id"]).collect() == []


def test_observed_counts_equal_those_of_the_tables(spark, scratch):
    lake = Lakehouse(f"{scratch}/lake")
    pipeline.ingest_bronze(lake, fixture_bronze(spark, SF_SMALL))
    now = pipeline.run_timestamp()
    counts = pipeline.build_silver(spark, lake, now)
    quarantines = {n: lake.read(spark, "ops", f"dq_{n}_quarantine") for n in DATASETS}
    want = sorted(map(tuple, ops.dq_issue_summary(quarantines).collect()))
    got = ops.dq_issue_summary_observed(spark, counts)
    assert sorted(map(tuple, got.select("dataset", "dq_issue", "issue_count").collect())) == want
    assert got.schema.simpleString() == ops.dq_issue_summary(quarantines).schema.simpleString()
    for n in DATASETS:
        written = ops.dq_metrics_written(n, lake.read(spark, "bronze", n),
                                         lake.read(spark, "silver", n), quarantines[n], now)
        assert written.collect() == lake.read(spark, "ops", "dq_metrics").where(
            F.col("dataset") == n).select(written.columns).collect()
