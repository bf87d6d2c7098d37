"""Steps whose cost grows with the rows they need, not with keys, names or empty bits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from navforge.functions.rules import issue_codes
from navforge.operators import distinct, gold
from navforge.operators.quality import attach_key_count
from navforge.plans import pipeline
from navforge.plans.chain import Chain
from navforge.sources.sinks import Lakehouse
from navforge.specs import DATASETS, POSITIONS
from tests.conftest import SF_SMALL


def _final(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_sparse_sets_take_a_row_an_id_and_no_empty_bits(spark):
    rows = spark.range(3000).selectExpr(
        "concat('F', id % 1000) as fund_id", "date'2024-01-01' as valuation_date",
        "'EUR' as currency", "concat('I', id * 7919 % 3000) as investor_id")
    codes = rows.select("investor_id", F.expr(
        "cast(substr(investor_id, 2) as long) * 1000").alias("code"))
    sets = distinct.daily_sets(rows, codes)
    size = sets.select(F.count(F.lit(1)), F.sum(F.octet_length(F.col("investors").cast("string"))))
    n, payload = size.first()
    assert n <= 3000 and payload <= 21 * n
    assert {r.investor_count for r in distinct.distinct_ids(sets, ["fund_id"]).collect()} == {3}
    # Every bit of a word, the sign's too, and codes past 2**33.
    wide = spark.range(200).select(F.col("id").cast("string").alias("investor_id"),
                                   (F.col("id") + (1 << 33)).alias("code"))
    rows = wide.select(F.lit("F").alias("fund_id"), F.lit("d").alias("valuation_date"),
                       F.lit("EUR").alias("currency"), "investor_id")
    sets = distinct.daily_sets(rows.union(rows), wide)
    assert sets.count() == 4
    assert distinct.distinct_ids(sets, ["fund_id"]).first().investor_count == 200


@pytest.mark.parametrize("collide", [False, True])
def test_keys_are_counted_among_repeated_hashes_only(spark, monkeypatch, collide):
    df = spark.range(400).selectExpr(
        "case when id % 40 = 0 then null else concat('k', least(id, 390)) end as a",
        "concat('x', id % 1) as b", "id")
    want = {r.id: r.n for r in attach_key_count(df, ("a", "b"), "n", measured=False).collect()}
    if collide:  # few hashes for many keys: the exact count decides
        monkeypatch.setattr(F, "xxhash64", lambda *c: F.hash(*c).cast("long") % 5)
    out = attach_key_count(df, ("a", "b"), "n")
    plan = _final(out)
    assert "LeftSemi" in plan and "SortMergeJoin" not in plan
    assert {r.id: r.n for r in out.collect()} == want
    assert sorted(set(want.values()), key=str) == [1, 10, None]


def test_issue_codes_are_compiled(spark):
    df = spark.createDataFrame([("", None, "Crypto")], "id string, units string, asset_class string")
    rules = [r for r in POSITIONS.rules if r.code in (
        "MISSING_POSITION_ID", "INVALID_ASSET_CLASS", "INVALID_UNITS")]
    out = df.select(issue_codes(rules).alias("i"))
    assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.schema["i"].dataType.simpleString() == "array<string>"
    assert out.first().i == ["MISSING_POSITION_ID", "INVALID_ASSET_CLASS", "INVALID_UNITS"]


def test_gold_groups_facts_once_and_counts_copies(spark):
    """Names are not grouped by; equal and unequal copies of dimension rows count as joined."""
    facts = spark.range(300).selectExpr(
        "concat('F', id % 5) as fund_id", "concat('I', id % 7) as investor_id",
        "case when id % 11 = 0 then null else date'2024-01-01' end as valuation_date",
        "element_at(array('Equity','Bond'), int(id % 2 + 1)) as asset_class", "'EUR' as currency",
        "cast(id / 3 as decimal(18,2)) as market_value", "cast(id / 7 as decimal(18,4)) as units")
    funds = spark.createDataFrame(
        [("F0", "a", "t", "m"), ("F0", "a", "t", "m"), ("F0", "b", None, "m"), ("F1", "c", "t", None)],
        "id string, name string, type string, manager string")
    investors = spark.createDataFrame(
        [("I1", "x", "LU", "Low", "t"), ("I1", "x", "LU", "Low", "t"), ("I2", "y", None, "Low", "t")],
        "id string, name string, country string, risk_profile string, investor_type string")
    f = funds.selectExpr("id fund_id", "name fund_name", "type fund_type", "manager")
    i = investors.selectExpr("id investor_id", "name investor_name", "country", "risk_profile",
                             "investor_type")
    joined = facts.join(f, "fund_id", "left").join(i, "investor_id", "left")
    held = gold.investor_positions(facts, funds, investors)
    keys = held.columns[:11]
    want = joined.groupBy(*keys).agg(
        F.sum("market_value").cast("decimal(28,2)").alias("market_value"),
        F.sum("units").cast("decimal(28,4)").alias("units"), F.count(F.lit(1)).alias("position_count"))
    assert sorted(map(tuple, held.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    shares = gold.asset_allocation(facts, funds)
    group = ["fund_id", "valuation_date", "currency"]
    base = facts.join(f, "fund_id", "left")
    total = base.groupBy(*group).agg(F.sum("market_value").alias("total_market_value"))
    want = base.groupBy(*group, "fund_name", "fund_type", "manager", "asset_class").agg(
        F.sum("market_value").cast("decimal(28,2)").alias("market_value")).join(
        total, group, "left").select(*shares.columns[:-1])
    assert sorted(map(tuple, shares.drop("allocation_pct").collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)
    for df in (held, shares):  # above the first broadcast: one aggregate, partial and final
        assert _final(df).split("BroadcastExchange")[0].count("HashAggregate") == 2


def test_refresh_steps_go_side_by_side(spark, tmp_path):
    """Tables are replaced by the timer's threads; a day without rows left goes from all."""
    lake = Lakehouse(str(tmp_path / "lake"), days=pipeline.DAYS)
    now = pipeline.run_timestamp()
    silver = {n: Chain(spark, SF_SMALL).silver(n) for n in DATASETS}
    few = (F.col("valuation_date") < "1995-04-01")
    for n, rows in silver.items():
        lake.write(rows.where(few) if n == "positions" else rows, "silver", n)
    pipeline.build_gold(spark, lake, now)
    rows = lake.read(spark, "silver", "positions")
    day = rows.agg(F.min("valuation_date")).first()[0]
    gone = spark.createDataFrame([(day,)], "valuation_date date")
    lake.write(rows.where(F.col("valuation_date") != F.lit(day)), "silver", "positions")
    timer = pipeline.Timer(workers=4)
    assert pipeline.refresh_gold(spark, lake, now, positions=gone, timer=timer) == {
        "positions": [day]}
    assert set(timer.steps) == {"fund_nav_daily", "investor_positions", "asset_allocation"}
    for table in timer.steps:
        assert lake.read(spark, "gold", table).agg(F.min("valuation_date")).first()[0] > day
