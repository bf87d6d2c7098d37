"""Plan-shape regression tests: the physical plans keep their scale properties."""

from __future__ import annotations

import pytest

from navforge.operators import gold, ops
from navforge.operators.quality import prepare_reference, valid_rows, validate
from navforge.plans import pipeline
from navforge.sources.bronze import fixture_bronze
from navforge.sources.sinks import Lakehouse
from navforge.specs import DATASETS, POSITIONS
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lk = Lakehouse(str(tmp_path_factory.mktemp("plans-lake")))
    pipeline.run(spark, lk, bronze=fixture_bronze(spark, SF_SMALL))
    return lk


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # execute, so the adaptive plan is final
    return qe.executedPlan().toString()


def _final(plan: str) -> str:
    # the top-level final plan, without the initial-plan section
    return plan.split("+- == Initial Plan ==")[0]


def test_validation_broadcasts_and_prunes(spark, lake):
    refs = {d: prepare_reference(lake.read(spark, "silver", d)) for d in ("funds", "investors")}
    df = valid_rows(validate(lake.read(spark, "bronze", "positions"), POSITIONS, refs,
                             prepared=True), POSITIONS)
    plan = _plan(df)
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 3
    assert "ReadSchema: struct<position_id:string>" in plan  # key count reads one column


def test_investor_positions_has_one_exchange(spark, lake):
    df = gold.investor_positions(lake.read(spark, "silver", "positions"),
                                 lake.read(spark, "silver", "funds"),
                                 lake.read(spark, "silver", "investors"))
    final = _final(_plan(df))
    top = final.split("BroadcastExchange")[0]  # the fact-side pipeline above the dimensions
    assert top.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in final


def test_issue_summary_single_shuffle(spark, lake):
    df = ops.dq_issue_summary({n: lake.read(spark, "ops", f"dq_{n}_quarantine")
                               for n in DATASETS})
    assert _final(_plan(df)).count("Exchange hashpartitioning") == 1


def test_latest_summary_limits_before_shuffle(spark, lake):
    plan = _plan(ops.dq_latest_summary(lake.read(spark, "ops", "dq_metrics")))
    assert plan.count("WindowGroupLimit") >= 2  # partial (before the exchange) and final


def test_latest_nav_reads_positions_once(spark, lake):
    nav = gold.fund_nav_daily(lake.read(spark, "silver", "positions"),
                              lake.read(spark, "silver", "funds"))
    assert _final(_plan(gold.latest_nav(nav))).count("silver/positions") == 1


def test_silver_keeps_nothing_on_executors(spark, lake):
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    df = validate(lake.read(spark, "bronze", "positions"), POSITIONS, {
        d: prepare_reference(lake.read(spark, "silver", d)) for d in ("funds", "investors")},
        prepared=True)
    assert "InMemoryRelation" not in _plan(df)


@pytest.mark.parametrize("table", ["fund_nav_daily", "investor_positions", "fund_cashflows",
                                   "asset_allocation"])
def test_gold_past_the_broadcast_bound(spark, lake, table):
    """Every dimension too large to broadcast, nearly every key hot: the same rows."""
    def build():
        silver = {n: lake.read(spark, "silver", n) for n in DATASETS}
        facts = silver["transactions" if table == "fund_cashflows" else "positions"]
        dims = [silver["funds"]] + [silver["investors"]] * (table == "investor_positions")
        return sorted(map(tuple, getattr(gold, table)(facts, *dims).collect()), key=str)

    want = build()
    conf = {"navforge.broadcast.maxRows": "3", "navforge.skew.hotKeyRows": "40"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert build() == want
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_third_of_rows_on_one_key_and_nulls(spark):
    from navforge.operators.joins import lookup_join, size_side

    left = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null "
        "else concat('k', id % 50) end as k", "id")
    right = spark.range(45).selectExpr("concat('k', id) as k", "id * 2 as v").union(
        spark.createDataFrame([("hot", 7), ("hot", 8)], "k string, v long"))
    plain = {how: sorted(map(tuple, left.join(right, "k", how).select("k", "id", "v").collect()),
                         key=str) for how in ("left", "inner")}
    spark.conf.set("navforge.broadcast.maxRows", "2")
    spark.conf.set("navforge.skew.hotKeyRows", "500")
    try:
        side = size_side(right)
        assert not side.broadcast
        for how, want in plain.items():
            got = lookup_join(left, side, ["k"], how).select("k", "id", "v").collect()
            assert sorted(map(tuple, got), key=str) == want
    finally:
        spark.conf.unset("navforge.broadcast.maxRows")
        spark.conf.unset("navforge.skew.hotKeyRows")


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from navforge import session

    monkeypatch.setattr(session, "is_local", lambda spark: False)
    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(spark)
