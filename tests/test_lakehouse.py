"""The one commit path of batches, streams and retention; malformed lines; days of facts."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from navforge.operators.quality import quarantine_rows, valid_rows, validate
from navforge.plans import pipeline
from navforge.sources.bronze import fixture_bronze, read_bronze_csv, spread, write_bronze_csv
from navforge.sources.sinks import Lakehouse
from navforge.specs import DATASETS, INVESTORS, MARKET_PRICES, POSITIONS
from navforge.streaming.ingest import ingest_table
from tests.conftest import SF_SMALL


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_ingest_retain_ingest_rerun_keeps_each_row_once(spark, scratch):
    raw = fixture_bronze(spark, SF_SMALL, ("positions",))["positions"].cache()
    lake, args = Lakehouse(f"{scratch}/lake"), (f"{scratch}/raw/*", POSITIONS)
    first = raw.where("currency = 'EUR'")
    write_bronze_csv(first, f"{scratch}/raw/a")
    assert ingest_table(spark, *args, lake, f"{scratch}/ckpt") == first.count()
    # As pipeline.retain does it.
    cutoff = F.col("valuation_date") < "1995-01-01"
    assert lake.delete_where(spark, "bronze", "positions", cutoff) == 1
    left = first.where(~F.coalesce(cutoff, F.lit(False))).count()
    assert lake.read(spark, "bronze", "positions").count() == left < first.count()
    second = raw.where("coalesce(currency <> 'EUR', true)")
    write_bronze_csv(second, f"{scratch}/raw/b")
    assert ingest_table(spark, *args, lake, f"{scratch}/ckpt") == second.count()
    assert ingest_table(spark, *args, lake, f"{scratch}/ckpt") == 0
    assert Lakehouse(f"{scratch}/lake").read(spark, "bronze", "positions").count() == \
        left + second.count()
    lake.compact(spark, "bronze", "positions")
    assert len(lake.paths(spark, "bronze", "positions")) == 1
    assert ingest_table(spark, *args, lake, f"{scratch}/ckpt") == 0
    assert lake.read(spark, "bronze", "positions").count() == left + second.count()
    raw.unpersist()


def test_batch_whose_commit_the_stream_lost_is_not_added_twice(spark, scratch):
    raw = fixture_bronze(spark, SF_SMALL, ("investors",))["investors"]
    lake, args = Lakehouse(f"{scratch}/lake"), (f"{scratch}/raw/*", INVESTORS)
    write_bronze_csv(raw, f"{scratch}/raw/a")
    n = ingest_table(spark, *args, lake, f"{scratch}/ckpt")
    for f in os.listdir(f"{scratch}/ckpt/commits"):  # the job ended before this file
        if f.lstrip(".").startswith("0"):
            os.remove(f"{scratch}/ckpt/commits/{f}")
    assert ingest_table(spark, *args, lake, f"{scratch}/ckpt") == 0
    assert lake.read(spark, "bronze", "investors").count() == n == raw.count()


def test_append_is_all_or_nothing_and_once(spark, scratch):
    lake = Lakehouse(f"{scratch}/lake")
    assert lake.write(spark.range(5).toDF("x"), "ops", "t", "append", batch=("job", 1))
    assert not lake.write(spark.range(5).toDF("x"), "ops", "t", "append", batch=("job", 1))
    assert not lake.write(spark.range(5).toDF("x"), "ops", "t", "append", batch=("job", 0))
    bad = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(
        F.raise_error(F.lit("stop"))).cast("long").alias("x"))
    with pytest.raises(Exception, match="stop"):
        lake.write(bad, "ops", "t", "append", batch=("job", 2))
    assert lake.read(spark, "ops", "t").count() == 5
    assert lake.write(spark.range(3).toDF("x"), "ops", "t", "append", batch=("job", 2))
    lake.write(lake.read(spark, "ops", "t").where("x > 0"), "ops", "t")  # an overwrite
    assert not lake.write(spark.range(3).toDF("x"), "ops", "t", "append", batch=("job", 2))
    assert lake.read(spark, "ops", "t").count() == 6


def test_append_with_more_columns(spark, scratch):
    lake = Lakehouse(f"{scratch}/lake")
    lake.write(spark.sql("SELECT 1 AS a, 'x' AS b"), "ops", "t", "append")
    lake.write(spark.sql("SELECT 2 AS a, 2.5D AS c"), "ops", "t", "append")
    got = Lakehouse(f"{scratch}/lake").read(spark, "ops", "t")
    assert got.columns == ["a", "b", "c"]
    assert sorted(map(tuple, got.collect())) == [(1, "x", None), (2, None, 2.5)]
    with pytest.raises(ValueError, match="column a"):
        lake.write(spark.sql("SELECT 'no number' AS a"), "ops", "t", "append")
    assert lake.read(spark, "ops", "t").count() == 2


def test_delete_where_rewrites_only_folders_with_such_rows(spark, scratch):
    lake = Lakehouse(f"{scratch}/lake")
    for i in range(3):
        lake.write(spark.range(i * 10, i * 10 + 10).toDF("x"), "ops", "t", "append")
    before = lake.paths(spark, "ops", "t")
    assert lake.delete_where(spark, "ops", "t", F.col("x").between(12, 15)) == 1
    after = lake.paths(spark, "ops", "t")
    assert after[0] == before[0] and after[2] == before[2] and after[1] != before[1]
    assert lake.read(spark, "ops", "t").count() == 26
    assert lake.delete_where(spark, "ops", "t", F.col("x") > 99) == 0


def test_a_day_ages_without_touching_the_others(spark, scratch):
    lake = Lakehouse(f"{scratch}/lake", days=pipeline.DAYS)
    pipeline.run(spark, lake, bronze=fixture_bronze(spark, SF_SMALL))
    nav = lake.read(spark, "gold", "fund_nav_daily")
    days = sorted(r[0] for r in nav.select("valuation_date").distinct().collect())
    counts = {k: lake.read(spark, *k).count() for k in pipeline.DAYS}
    [folder] = lake.paths(spark, "gold", "fund_nav_daily")
    before = files(folder)
    # Just past the end of the gold window of the two first days.
    as_of = dt.date(days[2].year + 7, days[2].month, days[2].day)
    touched = pipeline.retain(spark, lake, as_of)
    assert touched["gold/fund_nav_daily"] == 2
    after = files(folder)
    assert after == {f: t for f, t in before.items()
                     if not any(f"valuation_date={d}" in f for d in days[:2])}
    again = pipeline.retain(spark, lake, as_of)
    assert all(n == 0 for n in again.values())
    left = lake.read(spark, "gold", "fund_nav_daily")
    assert left.agg(F.min("valuation_date")).first()[0] == days[2]
    assert left.count() < counts["gold", "fund_nav_daily"]
    plan = left.where(F.col("valuation_date") == F.lit(days[5]))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(valuation_date" in plan


def test_refresh_equals_a_full_build_and_leaves_other_days(spark, scratch):
    lake = Lakehouse(f"{scratch}/lake", days=pipeline.DAYS)
    now = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    pipeline.run(spark, lake, bronze=fixture_bronze(spark, SF_SMALL), run_ts=now)
    full = {t: rows_of(lake.read(spark, "gold", t)) for t in
            (*pipeline.AGED["gold"], "api_fund_summary")}
    late = {}
    for n, column in (("positions", "valuation_date"), ("transactions", "transaction_date")):
        rows = lake.read(spark, "silver", n)
        last = rows.agg(F.max(column)).first()[0]
        cut = (F.col(column) == F.lit(last)) | ((F.col(column) < "1992-06-01")
                                                & (F.length("fund_id") == 2))
        late[n] = spark.createDataFrame(rows.where(cut).toPandas(), rows.schema)
        lake.write(rows.where(~cut), "silver", n)
    pipeline.build_gold(spark, lake, now)
    assert rows_of(lake.read(spark, "gold", "fund_nav_daily")) != full["fund_nav_daily"]
    [folder] = lake.paths(spark, "gold", "asset_allocation")
    before = files(folder)
    for n, rows in late.items():
        lake.write(rows, "silver", n, mode="append")
    days = pipeline.refresh_gold(spark, lake, now, **late)
    for t, want in full.items():
        assert rows_of(lake.read(spark, "gold", t).select(
            lake.read(spark, "gold", t).columns)) == want, t
    kept = {f: t for f, t in before.items()
            if not any(f"valuation_date={d}" in f for d in days["positions"])}
    assert kept and kept.items() <= files(folder).items()
    # All rows of a day go: its gold goes too.
    gone = days["positions"][-1]
    lake.drop_days(spark, "silver", "positions", dt.date(1, 1, 1))
    rows = lake.read(spark, "silver", "positions").where(F.col("valuation_date") == F.lit(gone))
    rows = spark.createDataFrame(rows.toPandas(), rows.schema)
    lake.delete_where(spark, "silver", "positions", F.col("valuation_date") == F.lit(gone))
    pipeline.refresh_gold(spark, lake, now, positions=rows)
    assert lake.read(spark, "gold", "fund_nav_daily").where(
        F.col("valuation_date") == F.lit(gone)).isEmpty()


RAGGED = """asset_id,fund_id,price_date,close_price,currency
A1,F1,2024-01-01,10.5,EUR
B,F,2024-01-01,1,5,EUR
C,F
A1,F1,2024-01-01

"quoted, cell",F1,2024-01-02,3,EUR
,,,,
"""


@pytest.mark.parametrize("by", ["batch", "stream"])
def test_malformed_lines_reach_the_quarantine_with_their_text(spark, scratch, by):
    os.makedirs(f"{scratch}/raw")
    with open(f"{scratch}/raw/a.csv", "w") as f:
        f.write(RAGGED)
    if by == "batch":
        raw = read_bronze_csv(spark, f"{scratch}/raw", MARKET_PRICES, keep_malformed=True)
    else:
        lake = Lakehouse(f"{scratch}/lake")
        assert ingest_table(spark, f"{scratch}/raw", MARKET_PRICES, lake, f"{scratch}/ckpt") == 6
        raw = lake.read(spark, "bronze", "market_prices")
    funds = spark.createDataFrame([("F1",), ("F",)], "id string")
    checked = validate(raw, MARKET_PRICES, {"funds": funds})
    bad = quarantine_rows(checked)
    got = {r["raw_line"]: r["dq_issues"] for r in bad.collect() if r["raw_line"] is not None}
    assert got == {line: ["MALFORMED_LINE"] for line in
                   ("B,F,2024-01-01,1,5,EUR", "C,F", "A1,F1,2024-01-01")}
    # The short line's key does not make the whole line's a duplicate.
    good = valid_rows(checked, MARKET_PRICES)
    assert "raw_line" not in good.columns
    assert sorted(r["asset_id"] for r in good.collect()) == ["A1", "quoted, cell"]
    assert good.count() + bad.count() == raw.count() == 6


def test_malformed_lines_in_a_whole_run(spark, scratch):
    from navforge.sources.bronze import load_bronze_csv

    for name, df in fixture_bronze(spark, SF_SMALL).items():
        write_bronze_csv(df, f"{scratch}/raw/{name}")
    with open(f"{scratch}/raw/market_prices/more.csv", "w") as f:
        f.write(RAGGED)
    lake = Lakehouse(f"{scratch}/lake")
    pipeline.run(spark, lake, load_bronze_csv(spark, f"{scratch}/raw", keep_malformed=True))
    issues = {(r["dataset"], r["dq_issue"]): r["issue_count"]
              for r in lake.read(spark, "ops", "dq_issue_summary").collect()}
    assert issues["market_prices", "MALFORMED_LINE"] == 3
    assert "raw_line" not in lake.read(spark, "silver", "market_prices").columns
    for n in DATASETS:
        assert lake.read(spark, "silver", n).count() + lake.read(
            spark, "ops", f"dq_{n}_quarantine").count() == lake.read(spark, "bronze", n).count()


def test_a_run_repeated_under_its_id_adds_no_metrics(spark, scratch):
    lake = Lakehouse(f"{scratch}/lake", register=True)
    pipeline.run(spark, lake, bronze=fixture_bronze(spark, SF_SMALL), run_id="monday")
    pipeline.run(spark, lake, run_id="monday")
    assert lake.read(spark, "ops", "dq_metrics").count() == 5
    pipeline.run(spark, lake, run_id="tuesday")
    assert lake.read(spark, "ops", "dq_metrics").count() == 10
    assert spark.table("ops.dq_metrics").count() == 10  # a view over both appends


def test_only_small_inputs_are_spread(spark, scratch):
    spark.range(200_000).write.parquet(f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t")
    assert "RoundRobin" in spread(df)._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        assert "RoundRobin" not in spread(df)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
