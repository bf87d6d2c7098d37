"""Property-style invariants over the fixture chain (sf0.001) and the quirk flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from navforge.plans.chain import Chain
from navforge.specs import DATASETS
from tests.conftest import SF_SMALL


def test_dedupe_refs_split_adds_up_to_bronze(spark):
    chain = Chain(spark, SF_SMALL)
    for name in DATASETS:
        total = chain.bronze[name].count()
        assert chain.silver(name).count() + chain.quarantine(name).count() == total, name


def test_without_dedupe_repeated_fund_ids_fan_out(spark):
    # Reference semantics: a fund id repeated in silver multiplies dependent rows.
    chain = Chain(spark, SF_SMALL, dedupe_refs=False)
    assert chain.bronze["transactions"].count() == 1506
    assert chain.silver("transactions").count() == 1126
    assert chain.quarantine("transactions").count() == 528


def test_scores_within_bounds_and_issue_counts_agree(spark):
    chain = Chain(spark, SF_SMALL)
    for r in chain.dq_metrics.collect():
        assert 0 <= r["dq_score"] <= 100
        assert r["valid_records"] + r["invalid_records"] == r["total_records"]
    issues = chain.dq_issue_summary.agg(F.sum("issue_count")).first()[0]
    per_row = sum(chain.quarantine(n).agg(F.sum(F.size("dq_issues"))).first()[0]
                  for n in DATASETS)
    assert issues == per_row


def test_allocation_sums_to_100(spark):
    chain = Chain(spark, SF_SMALL)
    sums = (chain.asset_allocation.where(F.col("allocation_pct").isNotNull())
            .groupBy("fund_id", "fund_name", "valuation_date", "currency")
            .agg(F.sum("allocation_pct").alias("s"), F.count(F.lit(1)).alias("n"))
            .collect())
    assert sums
    copies = {r["id"]: r["n"] for r in chain.silver("funds").groupBy("id")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in sums:
        # a repeated fund id divides the share among its name variants (reference semantics)
        whole = 100.0 / copies.get(r["fund_id"], 1)
        assert abs(float(r["s"]) - whole) <= 0.01 * r["n"], r


def test_nav_total_equals_silver_market_value_for_unique_funds(spark):
    chain = Chain(spark, SF_SMALL)
    unique_funds = chain.silver("funds").groupBy("id").count().where("count = 1").select(
        F.col("id").alias("fund_id"))
    nav = chain.fund_nav_daily.join(unique_funds, "fund_id").agg(F.sum("nav_amount")).first()[0]
    mv = chain.silver("positions").join(unique_funds, "fund_id").agg(
        F.sum("market_value")).first()[0]
    assert nav == mv


def test_fixture_split_counts_sf0001(spark):
    # FIXTURES.md section D (deduplicated references): (valid, quarantine) per dataset
    expected = {"funds": (9, 2), "investors": (132, 20), "transactions": (1001, 505),
                "positions": (3999, 2014), "market_prices": (139, 65)}
    chain = Chain(spark, SF_SMALL)
    got = {n: (chain.silver(n).count(), chain.quarantine(n).count()) for n in DATASETS}
    assert got == expected


def test_all_46_codes_fire_at_sf001(spark):
    from tests.conftest import SF_MEDIUM

    assert Chain(spark, SF_MEDIUM).dq_issue_summary.count() == 46
    # FIXTURES.md section D lists the counts under reference (fan-out) semantics
    rows = Chain(spark, SF_MEDIUM, dedupe_refs=False).dq_issue_summary.collect()
    by_code = {(r["dataset"], r["dq_issue"]): r["issue_count"] for r in rows}
    assert len(by_code) == 46
    assert by_code[("investors", "DUPLICATE_INVESTOR_ID")] == 42
    assert by_code[("funds", "INVALID_FUND_TYPE")] == 5
    assert by_code[("market_prices", "DUPLICATE_MARKET_PRICE_KEY")] == 262
    assert by_code[("transactions", "UNKNOWN_FUND_ID")] == 2673
    assert by_code[("positions", "UNKNOWN_INVESTOR_ID")] == 6533
