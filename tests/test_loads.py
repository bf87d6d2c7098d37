"""Validation load by load equals validation at once."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from navforge.operators.quality import ISSUES, quarantine_rows, valid_rows, validate
from navforge.plans import loads, pipeline
from navforge.sources.bronze import fixture_bronze
from navforge.sources.keyindex import KeyIndex
from navforge.sources.sinks import Lakehouse
from navforge.specs import DATASETS, FUNDS, INVESTORS, TRANSACTIONS
from tests.conftest import SF_SMALL

AT = dt.datetime(2024, 1, 1)
TIMES = ("processed_at", "quarantined_at", "created_at", "published_at")


def rows_of(df):
    df = df.select(*sorted(c for c in df.columns if c not in TIMES))
    return sorted(map(str, df.collect()))


def raw(spark, spec, rows):
    schema = ", ".join(f"{c} string" for c in spec.bronze_columns)
    return spark.createDataFrame(rows, schema)


def fund(i):
    return (i, "n", "Equity", "EUR", "2010-01-15", "Active", "LU", "m", "Low")


def investor(i):
    return (i, "n", "LU", "Low", "2020-01-05", "Active", "Pension Fund")


def transaction(i, f="F1", v="I1", day="2024-01-01"):
    return (i, f, v, day, "Switch", "5.00", "EUR")


def issues(lake, spark):
    q = lake.read(spark, "ops", "dq_transactions_quarantine")
    return {(r["id"], r["id_count"]): list(r[ISSUES]) for r in q.collect()}


def ids(lake, spark, table="transactions"):
    return sorted(r["id"] for r in lake.read(spark, "silver", table).collect())


def test_late_copy_takes_the_earlier_one_to_quarantine(spark, scratch):
    lake = Lakehouse(scratch)
    refs = {"funds": raw(spark, FUNDS, [fund("F1")]),
            "investors": raw(spark, INVESTORS, [investor("I1")])}
    loads.apply_load(spark, lake, 1, {**refs, "transactions": raw(spark, TRANSACTIONS, [
        transaction("a"), transaction("b"), transaction(None), transaction(None)])}, F.lit(AT), buckets=4)
    assert ids(lake, spark) == ["a", "b"]
    assert issues(lake, spark) == {(None, None): ["MISSING_TRANSACTION_ID"]}
    for n in (2, 3):
        done = loads.apply_load(spark, lake, n, {"transactions": raw(
            spark, TRANSACTIONS, [transaction("a"), transaction(f"c{n}")])}, F.lit(AT), buckets=4)
        assert done["transactions"].loads == list(range(1, n))
        assert ("a", n) in issues(lake, spark) and len(issues(lake, spark)) == 2
    assert ids(lake, spark) == ["b", "c2", "c3"]


def test_late_fund_releases_rows_and_late_investor_copy_takes_them_back(spark, scratch):
    lake = Lakehouse(scratch)
    loads.apply_load(spark, lake, 1, {"transactions": raw(spark, TRANSACTIONS, [
        transaction("a"), transaction("b", "F2")])}, F.lit(AT))  # no references at all yet
    assert ids(lake, spark) == []
    assert set(map(tuple, issues(lake, spark).values())) == {
        ("UNKNOWN_FUND_ID", "UNKNOWN_INVESTOR_ID")}
    done = loads.apply_load(spark, lake, 2, {"funds": raw(spark, FUNDS, [fund("F1")])}, F.lit(AT), buckets=4)
    assert done["transactions"].loads == [1]
    assert done["transactions"].days == [dt.date(2024, 1, 1)]
    assert issues(lake, spark)[("a", 1)] == ["UNKNOWN_INVESTOR_ID"]
    loads.apply_load(spark, lake, 3, {"investors": raw(spark, INVESTORS, [investor("I1")])}, F.lit(AT), buckets=4)
    assert ids(lake, spark) == ["a"]
    loads.apply_load(spark, lake, 4, {"investors": raw(spark, INVESTORS, [investor("I1")])}, F.lit(AT), buckets=4)
    assert ids(lake, spark) == [] and ids(lake, spark, "investors") == []
    assert issues(lake, spark)[("a", 1)] == ["UNKNOWN_INVESTOR_ID"]
    # A fund that comes again changes no verdict, so that no part is written anew.
    done = loads.apply_load(spark, lake, 5, {"funds": raw(spark, FUNDS, [fund("F1")])}, F.lit(AT), buckets=4)
    assert done["transactions"].loads == []


def split_in_three(spark, scratch):
    """The fixture's rows, dealt row by row, so that copies meet in different loads."""
    out = {}
    for name, df in fixture_bronze(spark, SF_SMALL).items():
        path = f"{scratch}/raw/{name}"
        df.withColumn("part", F.monotonically_increasing_id() % 3).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


@pytest.fixture(params=["broadcast", "shuffled"])
def bounds(request, spark):
    if request.param == "shuffled":
        spark.conf.set("navforge.broadcast.maxRows", "0")
    yield request.param
    spark.conf.unset("navforge.broadcast.maxRows")


def test_three_loads_equal_one_and_repeats_change_nothing(spark, scratch, bounds, monkeypatch):
    whole, lake = split_in_three(spark, scratch), Lakehouse(f"{scratch}/lake")

    def load(n, order=("funds", "investors", "transactions", "market_prices")):
        return loads.apply_load(spark, lake, n, {
            d: whole[d].where(F.col("part") == n).drop("part") for d in order}, F.lit(AT), buckets=4)

    load(0)
    load(1)
    # The third load breaks off after silver of transactions is published, then runs again.
    publish = Lakehouse.publish_parts

    def broken(self, session, layer, table, saved):
        if (layer, table) == ("ops", "dq_transactions_quarantine"):
            raise OSError("lost")
        publish(self, session, layer, table, saved)

    monkeypatch.setattr(Lakehouse, "publish_parts", broken)
    with pytest.raises(OSError):
        load(2)
    monkeypatch.setattr(Lakehouse, "publish_parts", publish)
    done = load(2)
    assert done["transactions"].loads == [0, 1]
    metrics = lake.read(spark, "ops", "dq_metrics").count()

    def check():
        refs = {}
        for name in ("funds", "investors", "transactions", "market_prices"):
            spec = DATASETS[name]
            full = validate(whole[name].drop("part"), spec, refs)
            refs[name] = valid_rows(full, spec)
            assert rows_of(lake.read(spark, "silver", name)) == rows_of(refs[name]), name
            assert rows_of(lake.read(spark, "ops", f"dq_{name}_quarantine")) == \
                rows_of(quarantine_rows(full)), name

    check()
    if bounds == "broadcast":
        load(2)
        check()
        assert lake.read(spark, "ops", "dq_metrics").count() == metrics


def test_gold_refreshed_by_the_days_of_loads_equals_a_full_build(spark, scratch):
    whole = split_in_three(spark, scratch)
    lake = Lakehouse(f"{scratch}/lake", days=pipeline.DAYS)
    for n in range(3):
        done = loads.apply_load(spark, lake, n, {
            d: df.where(F.col("part") == n).drop("part") for d, df in whole.items()}, F.lit(AT), buckets=4)
        if n == 0:
            pipeline.build_gold(spark, lake, F.lit(AT))
            continue
        pipeline.refresh_gold(spark, lake, F.lit(AT), **{
            d: spark.createDataFrame([(x,) for x in done[d].days], f"{c} date")
            for d, c in (("positions", "valuation_date"), ("transactions", "transaction_date"))})
    full = Lakehouse(f"{scratch}/full")
    pipeline.run(spark, full, {d: df.drop("part") for d, df in whole.items()})
    for table in ("fund_nav_daily", "investor_positions", "fund_cashflows", "asset_allocation",
                  "api_fund_summary"):
        assert rows_of(lake.read(spark, "gold", table)) == \
            rows_of(full.read(spark, "gold", table)), table


def test_earlier_keys_are_not_shuffled(spark, scratch):
    index = KeyIndex(f"{scratch}/keys", ("id",), buckets=4)
    keys = spark.range(3000).selectExpr("cast(id % 1000 as string) as id")
    index.add(keys, 1)
    index.add(keys.where("id < '5'"), 2)
    index.add(keys.where("id < '5'"), 2)  # again: the same record
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = KeyIndex(f"{scratch}/keys", ("id",), buckets=9).repeated(spark, 2)
        got = {(r["id"], r["__total"], r["__earlier"]) for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(str(i), 6, True) for i in range(1000) if str(i) < "5"}
    assert "Exchange" not in plan and "SortMergeJoin" in plan
