"""Unit cases per rule kind and per quirk, on hand-written rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from navforge.functions.parse import parse_decimal, parse_timestamp
from navforge.functions.rules import issue_codes
from navforge.operators import gold, ops
from navforge.operators.quality import (
    attach_key_count, attach_reference, prepare_reference, quarantine_rows, valid_rows,
    validate,
)
from navforge.specs import (
    FUNDS, INVESTORS, MARKET_PRICES, POSITIONS, TRANSACTIONS, Allowed, Bound, Known, Parsed,
    Required, Unique,
)


def _one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_dates_parse_strictly(spark):
    vals = ["2024-01-15", "2024-1-5", "2024-02-30", "15/01/2024", "", None, "2024-01-15 10:00"]
    out = _one_col(spark, vals).select(parse_timestamp("v").alias("p")).collect()
    assert out[0]["p"] == dt.datetime(2024, 1, 15)
    assert [r["p"] for r in out[1:]] == [None] * 6


def test_decimals_round_half_up_and_null_on_failure(spark):
    vals = ["12.345", "-12.345", "1e3", "abc", "", "99999999999999999999"]
    out = [r["p"] for r in _one_col(spark, vals).select(parse_decimal("v", 18, 2).alias("p")).collect()]
    assert out == [Decimal("12.35"), Decimal("-12.35"), Decimal("1000.00"), None, None, None]


def test_decimal_comma(spark):
    out = [r["p"] for r in _one_col(spark, ["1234,50", "1.234,50"])
           .select(parse_decimal("v", 18, 2, decimal_comma=True).alias("p")).collect()]
    assert out == [Decimal("1234.50"), None]


def test_rule_kinds_null_semantics(spark):
    df = spark.createDataFrame(
        [("EUR", "x", 5, 1), (None, None, None, None), ("GBP", "", -1, 2), ("  EUR", "y", 0, 1)],
        "c string, r string, n int, k bigint")
    rules = (Allowed("c", ("EUR",), "BAD_C"), Required("r", "MISSING_R"),
             Parsed("n", "NO_N"), Bound("n", "<=", 0, "NON_POS"), Unique("k", "DUP"))
    got = [r["i"] for r in df.select(issue_codes(rules).alias("i")).collect()]
    assert got == [[], ["MISSING_R", "NO_N"], ["BAD_C", "MISSING_R", "NON_POS", "DUP"],
                   ["BAD_C", "NON_POS"]]
    assert df.select(issue_codes((Known("r", "UNK"),)).alias("i")).collect()[1]["i"] == ["UNK"]


def test_null_id_is_missing_not_duplicate_blank_is_both(spark):
    rows = [(None, "A"), (None, "B"), ("  ", "C"), ("  ", "D"), ("I1", "E")]
    bronze = spark.createDataFrame(
        [(i, n, "LU", "Low", "2020-01-05", "Active", "Insurance") for i, n in rows],
        ",".join(f"{c} string" for c in INVESTORS.bronze_columns))
    v = validate(bronze, INVESTORS, measured=True).orderBy("name").collect()
    assert [r["dq_issues"] for r in v] == [
        ["MISSING_INVESTOR_ID"], ["MISSING_INVESTOR_ID"],
        ["MISSING_INVESTOR_ID", "DUPLICATE_INVESTOR_ID"],
        ["MISSING_INVESTOR_ID", "DUPLICATE_INVESTOR_ID"], []]
    assert [r["id_count"] for r in v] == [None, None, 2, 2, 1]


def test_key_count_measured_equals_shuffle_join(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("", 5), ("", 6)],
                               "id string, x int")
    a = sorted(map(tuple, attach_key_count(df, ("id",), "n", True).collect()), key=str)
    b = sorted(map(tuple, attach_key_count(df, ("id",), "n", False).collect()), key=str)
    assert a == b
    assert dict((r[1], r[2]) for r in a) == {1: 2, 2: 2, 3: 1, 4: None, 5: 2, 6: 2}


def test_composite_key_with_null_part_has_no_count(spark):
    df = spark.createDataFrame([("A1", "F1", "d"), ("A1", "F1", "d"), ("A1", None, "d"),
                                ("A1", None, "d")], "asset_id string, fund_id string, price_date_raw string")
    got = sorted(r["key_count"] or 0 for r in
                 attach_key_count(df, MARKET_PRICES.key, "key_count").collect())
    assert got == [0, 0, 2, 2]


def test_reference_dedupe_prevents_fan_out(spark):
    base = spark.createDataFrame([("T1", "F1"), ("T2", "F9")], "id string, fund_id string")
    funds = spark.createDataFrame([("F1",), ("F1",)], "id string")
    for dedupe, rows in ((True, 2), (False, 3)):
        keys = prepare_reference(funds, dedupe=dedupe)
        assert attach_reference(base, "fund_id", keys, "valid_fund_id").count() == rows


def test_split_columns_follow_published_layout(spark):
    cols = ",".join(f"{c} string" for c in FUNDS.bronze_columns)
    bronze = spark.createDataFrame(
        [(" F1 ", "Alpha", "Equity", "EUR", "2010-01-15", "Active", "LU", "M", "Low"),
         ("F2", "Beta", "Hedge", "GBP", "15/01/2010", "Active", "LU", "M", "Low")], cols)
    v = validate(bronze, FUNDS)
    silver = valid_rows(v, FUNDS, F.current_timestamp())
    assert silver.columns == ["id", "name", "type", "currency", "status", "domicile", "manager",
                              "risk_level", "inception_date", "processed_at"]
    q = quarantine_rows(v, F.current_timestamp())
    assert q.columns[-2:] == ["dq_issues", "quarantined_at"]
    row = q.collect()[0]
    assert row["dq_issues"] == ["INVALID_FUND_TYPE", "INVALID_CURRENCY", "INVALID_INCEPTION_DATE"]
    assert silver.collect()[0]["id"] == "F1"


def test_health_thresholds(spark):
    scores = [100.0, 99.0, 98.99, 95.0, 94.99, None]
    df = spark.createDataFrame([(s,) for s in scores], "dq_score double")
    got = [r["health_status"] for r in ops.pipeline_health(df).collect()]
    assert got == ["Healthy", "Healthy", "Warning", "Warning", "Critical", "Critical"]


def test_latest_summary_picks_newest_and_breaks_ties(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("funds", 1, 1, 0, 98.0, t1), ("funds", 1, 1, 0, 99.0, t2),
         ("positions", 1, 1, 0, 95.0, t1), ("positions", 1, 1, 0, 95.0, t1)],
        "dataset string, total_records long, valid_records long, invalid_records long, "
        "dq_score double, execution_date timestamp")
    got = sorted((r["dataset"], r["dq_score"]) for r in ops.dq_latest_summary(df).collect())
    assert got == [("funds", 99.0), ("positions", 95.0)]


def test_zero_total_allocation_is_null(spark):
    pos = spark.createDataFrame(
        [("F1", dt.date(2024, 1, 1), "Equity", "EUR", Decimal("0.00")),
         ("F1", dt.date(2024, 1, 1), "Bond", "EUR", Decimal("0.00"))],
        "fund_id string, valuation_date date, asset_class string, currency string, "
        "market_value decimal(18,2)")
    funds = spark.createDataFrame([("F1", "A", "Equity", "M")],
                                  "id string, name string, type string, manager string")
    out = gold.asset_allocation(pos, funds).collect()
    assert [r["allocation_pct"] for r in out] == [None, None]


def test_allocation_null_currency_gets_null_total(spark):
    pos = spark.createDataFrame(
        [("F1", dt.date(2024, 1, 1), "Equity", None, Decimal("10.00")),
         ("F1", dt.date(2024, 1, 1), "Equity", "EUR", Decimal("30.00")),
         ("F1", dt.date(2024, 1, 1), "Bond", "EUR", Decimal("10.00"))],
        "fund_id string, valuation_date date, asset_class string, currency string, "
        "market_value decimal(18,2)")
    funds = spark.createDataFrame([("F1", "A", "Equity", "M")],
                                  "id string, name string, type string, manager string")
    out = {(r["asset_class"], r["currency"]): (r["total_market_value"], r["allocation_pct"])
           for r in gold.asset_allocation(pos, funds).collect()}
    assert out[("Equity", None)] == (None, None)
    assert out[("Equity", "EUR")] == (Decimal("40.00"), Decimal("75.00"))


def test_latest_nav_is_per_fund_across_currencies(spark):
    nav = spark.createDataFrame(
        [("F1", dt.date(2024, 1, 2), "EUR", Decimal("1.00"), 1, 1, "A"),
         ("F1", dt.date(2024, 1, 1), "USD", Decimal("2.00"), 1, 1, "A")],
        "fund_id string, valuation_date date, currency string, nav_amount decimal(28,2), "
        "investor_count long, position_count long, fund_name string")
    got = [(r["currency"], r["fund_id"]) for r in gold.latest_nav(nav).collect()]
    assert got == [("EUR", "F1")]


def test_gold_aggregate_first_equals_join_first_with_repeated_dimension_rows(spark):
    pos = spark.createDataFrame(
        [("P1", "F1", "I1", "Equity", "EUR", Decimal("1.0000"), Decimal("10.00"), dt.date(2024, 1, 1)),
         ("P2", "F1", "I2", "Bond", "EUR", Decimal("2.0000"), Decimal("20.00"), dt.date(2024, 1, 1))],
        "id string, fund_id string, investor_id string, asset_class string, currency string, "
        "units decimal(18,4), market_value decimal(18,2), valuation_date date")
    # F1 appears twice with identical attributes: join-first doubles sums, not distinct counts
    funds = spark.createDataFrame([("F1", "A", "Equity", "M"), ("F1", "A", "Equity", "M")],
                                  "id string, name string, type string, manager string")
    investors = spark.createDataFrame([("I1", "X", "LU", "Low", "Insurance"),
                                       ("I2", "Y", "LU", "Low", "Insurance")],
                                      "id string, name string, country string, "
                                      "risk_profile string, investor_type string")
    ip = {r["investor_id"]: (r["market_value"], r["position_count"])
          for r in gold.investor_positions(pos, funds, investors).collect()}
    assert ip == {"I1": (Decimal("20.00"), 2), "I2": (Decimal("40.00"), 2)}
    tx = spark.createDataFrame(
        [("F1", dt.date(2024, 1, 1), "Subscription", "EUR", Decimal("5.00"), "I1"),
         ("F1", dt.date(2024, 1, 1), "Subscription", "EUR", Decimal("5.00"), "I1")],
        "fund_id string, transaction_date date, transaction_type string, currency string, "
        "amount decimal(18,2), investor_id string")
    cf = gold.fund_cashflows(tx, funds).collect()
    assert [(r["total_amount"], r["transaction_count"], r["investor_count"]) for r in cf] == \
        [(Decimal("20.00"), 4, 1)]


def test_specs_hold_46_rules():
    specs = (FUNDS, INVESTORS, TRANSACTIONS, POSITIONS, MARKET_PRICES)
    assert [len(s.rules) for s in specs] == [6, 8, 11, 13, 8]
    codes = [(s.name, r.code) for s in specs for r in s.rules]
    assert len(set(codes)) == 46


def test_key_count_split_fallback_matches_plain_join(spark):
    """Repeated-key set over the broadcast bound: shuffle join with split hot keys."""
    rows = [("a", i) for i in range(5)] + [("b", 10), ("b", 11), ("c", 20)] + \
        [(None, 30 + i) for i in range(3)]
    df = spark.createDataFrame(rows, "id string, x int")
    plain = sorted(map(tuple, attach_key_count(df, ("id",), "n", measured=False).collect()),
                   key=str)
    conf = {"navforge.broadcast.maxRows": "1", "navforge.skew.hotKeyRows": "2"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        split_df = attach_key_count(df, ("id",), "n", measured=True)
        plan = split_df._jdf.queryExecution().executedPlan().toString()
        split = sorted(map(tuple, split_df.collect()), key=str)
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "LeftAnti" in plan and "LeftSemi" in plan and "BroadcastHashJoin" in plan
    assert "monotonically_increasing_id" not in plan
    assert split == plain
    assert {r[1]: r[2] for r in split} == {0: 5, 1: 5, 2: 5, 3: 5, 4: 5, 10: 2, 11: 2, 20: 1,
                                             30: None, 31: None, 32: None}


def test_size_shuffles_targets_partition_bytes(spark):
    from navforge.session import size_shuffles

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                             "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                             "spark.sql.files.maxPartitionBytes")}
    try:
        assert size_shuffles(spark, 100 * (128 << 20)) == 100
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
        floor = 2 * spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, 1) == floor
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_reference_lookup_split_fallback_matches_broadcast(spark):
    base = spark.createDataFrame(
        [(f"T{i}", "F1" if i < 6 else ("F2" if i < 8 else None if i == 8 else "F9"))
         for i in range(10)], "id string, fund_id string")
    funds = spark.createDataFrame([("F1",), ("F2",), ("F3",)], "id string")
    fast = sorted(map(tuple, attach_reference(base, "fund_id", prepare_reference(funds),
                                              "valid_fund_id").collect()), key=str)
    conf = {"navforge.broadcast.maxRows": "1", "navforge.skew.hotKeyRows": "3"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        keys = prepare_reference(funds)
        assert not keys.broadcast
        out = attach_reference(base, "fund_id", keys, "valid_fund_id")
        assert out.columns == ["id", "fund_id", "valid_fund_id"]
        split = sorted(map(tuple, out.collect()), key=str)
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert split == fast
    assert sum(1 for r in fast if r[2] == "F1") == 6


def test_reference_lookup_split_fallback_keeps_fan_out_mode(spark):
    base = spark.createDataFrame([(f"T{i}", "F1" if i < 6 else "F2") for i in range(8)],
                                 "id string, fund_id string")
    funds = spark.createDataFrame([("F1",), ("F1",), ("F2",)], "id string")
    plain = attach_reference(base, "fund_id", prepare_reference(funds, dedupe=False),
                             "valid_fund_id").count()
    conf = {"navforge.broadcast.maxRows": "1", "navforge.skew.hotKeyRows": "3"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        keys = prepare_reference(funds, dedupe=False)
        split = attach_reference(base, "fund_id", keys, "valid_fund_id").count()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert not keys.broadcast
    assert split == plain == 6 * 2 + 2
