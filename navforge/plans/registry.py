"""Registered queries (Spark) and their DuckDB oracle SQL, keyed alike.

Every query takes ``(spark, sf_dir)``, derives the bronze fixtures from the
tables under ``sf_dir`` and runs the operator over all of it.  Audit
timestamps (processed_at, quarantined_at, created_at, execution_date) are left
out of the compared output; issue arrays are compared as comma-joined text.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navforge.operators import distinct, gold, ops, reports
from navforge.operators.quality import (
    attach_key_count, attach_reference, quarantine_rows, standardize, validate,
)
from navforge.plans import oracle
from navforge.plans.chain import Chain, issues_as_text
from navforge.session import ensure_checkpoint_dir
from navforge.plans import loads, pipeline
from navforge.sources.bronze import load_bronze_csv, read_bronze_csv, row_counts, write_bronze_csv
from navforge.sources.fixtures import ADAPTER_SQL
from navforge.sources.sinks import Lakehouse
from navforge.streaming.ingest import ingest_new_files, ingest_table
from navforge.specs import (
    DATASETS, HEALTH_FALLBACK, HEALTH_THRESHOLDS, MARKET_PRICES, POSITIONS, TRANSACTIONS,
    DatasetSpec,
)

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, with_fanout_run: bool = False,
             bronze: dict[str, str] | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = oracle.with_chain(sql, with_fanout_run=with_fanout_run, bronze=bronze)
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# -- bronze -------------------------------------------------------------------
@register("bronze_row_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM bronze_{n}" for n in DATASETS))
def bronze_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(Chain(spark, sf_dir).bronze)


# -- silver: per dataset --------------------------------------------------------
def _standardize_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return standardize(Chain(spark, sf_dir).bronze[name], DATASETS[name])
    return q


def _silver_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Chain(spark, sf_dir).silver(name)
    return q


def _quarantine_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return issues_as_text(Chain(spark, sf_dir).quarantine(name))
    return q


for _name, _spec in DATASETS.items():
    register(f"standardize_{_name}", oracle.standardize_select(_spec))(_standardize_query(_name))
    register(f"silver_{_name}", f"SELECT * FROM silver_{_name}")(_silver_query(_name))
    register(f"quarantine_{_name}", oracle.quarantine_select(_spec))(_quarantine_query(_name))


@register("duplicate_count", "SELECT id, id_count FROM key_positions")
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = standardize(Chain(spark, sf_dir).bronze["positions"], POSITIONS)
    return attach_key_count(base, POSITIONS.key, POSITIONS.count_column).select("id", "id_count")


@register("duplicate_count_composite",
          "SELECT asset_id, fund_id, price_date_raw, key_count FROM key_market_prices")
def duplicate_count_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = standardize(Chain(spark, sf_dir).bronze["market_prices"], MARKET_PRICES)
    return attach_key_count(base, MARKET_PRICES.key, MARKET_PRICES.count_column).select(
        *MARKET_PRICES.key, MARKET_PRICES.count_column)


@register("reference_check",
          "SELECT id, fund_id, investor_id, valid_fund_id, valid_investor_id FROM ref1_transactions")
def reference_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = Chain(spark, sf_dir)
    df = standardize(chain.bronze["transactions"], TRANSACTIONS)
    for ref in TRANSACTIONS.references:
        df = attach_reference(df, ref.column, chain.reference(ref.dataset), ref.out)
    return df.select("id", "fund_id", "investor_id", "valid_fund_id", "valid_investor_id")


# -- gold -----------------------------------------------------------------------
def _gold_query(attr: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Chain(spark, sf_dir), attr)
    return q


for _attr in ("fund_nav_daily", "investor_positions", "fund_cashflows", "asset_allocation",
              "latest_nav", "latest_cashflow_date", "api_fund_summary"):
    register(_attr, f"SELECT * FROM {_attr}")(_gold_query(_attr))


# -- ops ------------------------------------------------------------------------
def _ops_query(attr: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(Chain(spark, sf_dir), attr)
        return df.drop("execution_date")
    return q


register("dq_metrics", "SELECT * FROM dq_metrics")(_ops_query("dq_metrics"))

register("dq_issue_summary", "SELECT * FROM dq_issue_summary")(_gold_query("dq_issue_summary"))


# -- previews (ordered, so the first rows are well defined) -----------------------
def _preview_query(attr: str, n: int) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(Chain(spark, sf_dir), attr)
        return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)
    return q


def _preview_sql(table: str, columns: list[str], n: int) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    return f"SELECT * FROM {table} ORDER BY {order} LIMIT {n}"


_NAV_COLUMNS = ["fund_id", "valuation_date", "currency", "nav_amount", "investor_count",
                "position_count", "fund_name", "fund_type", "manager"]
register("preview_fund_nav_daily", _preview_sql("fund_nav_daily", _NAV_COLUMNS, 10))(
    _preview_query("fund_nav_daily", 10))

_SILVER_POSITION_COLUMNS = ["id", "fund_id", "investor_id", "asset_class", "currency", "units",
                            "market_value", "valuation_date"]
register("preview_silver_positions",
         _preview_sql("silver_positions", _SILVER_POSITION_COLUMNS, 20))(
    lambda spark, sf_dir: (lambda df: df.orderBy(
        *[F.col(c).asc_nulls_first() for c in df.columns]).limit(20))(
        Chain(spark, sf_dir).silver("positions")))


_PREVIEWS = {
    "investor_positions": ["investor_id", "investor_name", "country", "risk_profile",
                           "investor_type", "fund_id", "fund_name", "fund_type", "manager",
                           "valuation_date", "currency", "market_value", "units",
                           "position_count"],
    "fund_cashflows": ["fund_id", "fund_name", "fund_type", "manager", "transaction_date",
                       "transaction_type", "currency", "total_amount", "transaction_count",
                       "investor_count"],
    "asset_allocation": ["fund_id", "valuation_date", "currency", "fund_name", "fund_type",
                         "manager", "asset_class", "market_value", "total_market_value",
                         "allocation_pct"],
}
_PREVIEWS["api_fund_summary"] = [
    "fund_id", "fund_name", "fund_type", "base_currency", "status", "domicile", "manager",
    "risk_level", "valuation_date", "currency", "nav_amount", "investor_count", "position_count",
    "latest_transaction_date", "api_version"]
for _attr, _cols in _PREVIEWS.items():
    register(f"preview_{_attr}", _preview_sql(_attr, _cols, 10))(
        lambda spark, sf_dir, attr=_attr, cols=_cols: getattr(Chain(spark, sf_dir), attr)
        .orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(10))


def _ordered_head(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)


for _name, _spec in DATASETS.items():
    _cols = oracle.validated_columns(_spec)
    if _name != "positions":  # registered above
        _valid = oracle.silver_columns(_spec)
        register(f"preview_silver_{_name}", _preview_sql(f"silver_{_name}", _valid, 20))(
            lambda spark, sf_dir, name=_name, cols=_valid: _ordered_head(
                Chain(spark, sf_dir).silver(name), cols, 20))
    register(f"preview_quarantine_{_name}", _preview_sql(
        f"({oracle.quarantine_select(_spec)})", _cols, 20))(
        lambda spark, sf_dir, name=_name, cols=_cols: _ordered_head(
            issues_as_text(Chain(spark, sf_dir).quarantine(name)), cols, 20))


# -- raw CSV ingestion ------------------------------------------------------------
def _scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def _nullif(spec: DatasetSpec) -> str:
    return ", ".join(f"NULLIF({c}, '') AS {c}" for c in spec.bronze_columns)


_NULLIF = _nullif(POSITIONS)


def _bronze_load_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _scratch(spark, "bronze-load")
        write_bronze_csv(Chain(spark, sf_dir).bronze[name], f"{root}/{name}")
        return load_bronze_csv(spark, root, (name,))[name]
    return q


# Raw rows written as CSV and loaded back through the bronze reader (header checked,
# all text).  Empty cells read as NULL.
for _name, _spec in DATASETS.items():
    register(f"bronze_load_{_name}", f"SELECT {_nullif(_spec)} FROM bronze_{_name}")(
        _bronze_load_query(_name))
register("bronze_load", f"SELECT {_NULLIF} FROM bronze_positions")(_bronze_load_query("positions"))


@register("bronze_stream_ingest", f"SELECT {_NULLIF} FROM bronze_positions")
def bronze_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental ingestion: files are picked up once.  The raw CSV is loaded
    by an available-now file stream, then the stream is run again with no new
    files; the target holds every row exactly once."""
    root = _scratch(spark, "bronze-stream")
    write_bronze_csv(Chain(spark, sf_dir).bronze["positions"], f"{root}/incoming")
    for _ in range(2):
        ingest_new_files(spark, f"{root}/incoming", POSITIONS, f"{root}/bronze",
                         f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/bronze")


# -- metrics history and trend (two runs: fan-out semantics, then deduplicated) ----
_RUN_1 = dt.datetime(2024, 1, 1)
_RUN_2 = dt.datetime(2024, 1, 2)


def _two_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to a metrics table, read back."""
    first = Chain(spark, sf_dir, dedupe_refs=False, run_ts=F.lit(_RUN_1)).dq_metrics
    second = Chain(spark, sf_dir, dedupe_refs=True, run_ts=F.lit(_RUN_2)).dq_metrics
    root = _scratch(spark, "dq-metrics")
    lake = Lakehouse(root)
    lake.write(first, "ops", "dq_metrics", mode="append")
    lake.write(second, "ops", "dq_metrics", mode="append")
    return lake.read(spark, "ops", "dq_metrics")


_METRIC_COLS = "dataset, total_records, valid_records, invalid_records, dq_score"


@register("dq_metrics_history",
          f"SELECT {_METRIC_COLS} FROM {oracle.FANOUT}dq_metrics "
          f"UNION ALL SELECT {_METRIC_COLS} FROM dq_metrics", with_fanout_run=True)
def dq_metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_run_history(spark, sf_dir).drop("execution_date")


def _two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of two runs over the same tables, as a history would hold them."""
    first = Chain(spark, sf_dir, dedupe_refs=False, run_ts=F.lit(_RUN_1)).dq_metrics
    second = Chain(spark, sf_dir, dedupe_refs=True, run_ts=F.lit(_RUN_2)).dq_metrics
    return first.unionByName(second)


@register("dq_latest_summary", "SELECT * FROM dq_metrics")
def dq_latest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest of two runs per dataset (the deduplicated run)."""
    return ops.dq_latest_summary(_two_runs(spark, sf_dir)).drop("execution_date")


@register("pipeline_health", "SELECT * FROM pipeline_health")
def pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ops.dq_latest_summary(_two_runs(spark, sf_dir))
    return ops.pipeline_health(latest).drop("execution_date")


@register("dq_trend", f"""
SELECT dataset, dq_score, lag(dq_score) OVER (PARTITION BY dataset ORDER BY run) AS previous_dq_score,
       dq_score - lag(dq_score) OVER (PARTITION BY dataset ORDER BY run) AS dq_score_change
FROM (SELECT 1 AS run, * FROM {oracle.FANOUT}dq_metrics UNION ALL SELECT 2 AS run, * FROM dq_metrics)
""", with_fanout_run=True)
def dq_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dq_trend(_two_run_history(spark, sf_dir)).select(
        "dataset", "dq_score", "previous_dq_score", "dq_score_change")


# -- dashboard and governance reports -------------------------------------------
def _latest_sql(attrs: str) -> str:
    cols = f"fund_id, valuation_date, currency, {attrs}nav_amount"
    return f"""(SELECT n.* FROM (SELECT DISTINCT {cols} FROM fund_nav_daily) n
      JOIN (SELECT fund_id, max(valuation_date) AS d FROM fund_nav_daily GROUP BY fund_id) l
        ON n.fund_id = l.fund_id AND n.valuation_date = l.d)"""


@register("kpi_summary", f"""
SELECT 'total_nav' AS kpi, currency, CAST(sum(nav_amount) AS DECIMAL(38,2)) AS value
FROM {_latest_sql('')} GROUP BY currency
UNION ALL
SELECT 'total_cashflow', currency, CAST(sum(amount) AS DECIMAL(38,2))
FROM silver_transactions GROUP BY currency
UNION ALL
SELECT 'active_funds', NULL, CAST(count(DISTINCT id) AS DECIMAL(38,2))
FROM silver_funds WHERE status = 'Active'
UNION ALL
SELECT 'active_investors', NULL, CAST(count(DISTINCT id) AS DECIMAL(38,2))
FROM silver_investors WHERE status = 'Active'""")
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Chain(spark, sf_dir)
    return reports.kpi_summary(c.fund_nav_daily, c.silver("transactions"), c.silver("funds"),
                               c.silver("investors"))


@register("nav_by_fund_type", f"""
SELECT fund_type, currency, CAST(sum(nav_amount) AS DECIMAL(38,2)) AS nav_amount,
       count(DISTINCT fund_id) AS fund_count
FROM {_latest_sql('fund_type, ')} GROUP BY fund_type, currency""")
def nav_by_fund_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.nav_by_fund_type(Chain(spark, sf_dir).fund_nav_daily)


@register("nav_by_manager_top10", f"""
SELECT * FROM (
  SELECT manager, currency, nav_amount,
         CAST(row_number() OVER (PARTITION BY currency
                                 ORDER BY nav_amount DESC NULLS LAST, manager ASC NULLS LAST)
              AS INTEGER) AS rank
  FROM (SELECT manager, currency, CAST(sum(nav_amount) AS DECIMAL(38,2)) AS nav_amount
        FROM {_latest_sql('manager, ')} GROUP BY manager, currency))
WHERE rank <= 10""")
def nav_by_manager_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.nav_by_manager_top(Chain(spark, sf_dir).fund_nav_daily, 10)


def _distribution_sql(column: str, alias: str) -> str:
    return f"""
SELECT {alias}, fund_count,
       round(fund_count * CAST(100.0 AS DOUBLE) / sum(fund_count) OVER (), 2) AS share_pct
FROM (SELECT {column} AS {alias}, count(DISTINCT id) AS fund_count
      FROM silver_funds GROUP BY {column})"""


@register("fund_type_distribution", _distribution_sql("type", "fund_type"))
def fund_type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fund_type_distribution(Chain(spark, sf_dir).silver("funds"))


@register("risk_distribution", _distribution_sql("risk_level", "risk_level"))
def risk_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.risk_distribution(Chain(spark, sf_dir).silver("funds"))


@register("price_outliers", """
SELECT p.asset_id, p.fund_id, p.price_date, p.currency, p.close_price, s.mean_price,
       s.stddev_price
FROM silver_market_prices p
JOIN (SELECT asset_id, currency, avg(CAST(close_price AS DOUBLE)) AS mean_price,
             stddev_samp(CAST(close_price AS DOUBLE)) AS stddev_price
      FROM silver_market_prices GROUP BY asset_id, currency) s
  ON p.asset_id = s.asset_id AND p.currency = s.currency
WHERE abs(CAST(p.close_price AS DOUBLE) - s.mean_price) > 3 * s.stddev_price""")
def price_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.price_outliers(Chain(spark, sf_dir).silver("market_prices"))


#: Prices made from all of ``part``: one asset per brand, and every 97th part priced
#: far from the others (the market prices of the fixture have one or two per asset).
_PART_PRICES = """
SELECT p_brand AS asset_id, 'F' || CAST(p_partkey AS VARCHAR(20)) AS fund_id,
       DATE '2024-01-31' AS price_date, 'EUR' AS currency,
       CAST(CASE WHEN p_partkey % 97 = 5 THEN p_retailprice * 9 ELSE p_retailprice END
            AS DECIMAL(18,2)) AS close_price
FROM {part}"""


@register("price_outliers_dense", f"""
SELECT asset_id, fund_id, price_date, currency, close_price, round(mean_price, 6) AS mean_price,
       round(stddev_price, 6) AS stddev_price
FROM (SELECT *, avg(CAST(close_price AS DOUBLE)) OVER w AS mean_price,
             stddev_samp(CAST(close_price AS DOUBLE)) OVER w AS stddev_price
      FROM ({_PART_PRICES.replace('{part}', 'part')})
      WINDOW w AS (PARTITION BY asset_id, currency))
WHERE abs(CAST(close_price AS DOUBLE) - mean_price) > 3 * stddev_price""")
def price_outliers_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = spark.sql(_PART_PRICES, part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    out = reports.price_outliers(prices)
    return out.withColumns({c: F.round(c, 6) for c in ("mean_price", "stddev_price")})


# -- retention, as of dates that leave part of the data behind ---------------------
_AS_OF = {"bronze": "1998-06-30", "silver": "1999-06-30", "gold": "2004-06-30"}


@register("retention_bronze", f"""
SELECT * FROM bronze_positions
WHERE coalesce(try_strptime(trim(valuation_date), '%Y-%m-%d')
               >= DATE '{_AS_OF['bronze']}' - INTERVAL 90 DAY, true)""")
def retention_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.apply_retention(Chain(spark, sf_dir).bronze["positions"], "valuation_date",
                                   "bronze", F.lit(_AS_OF["bronze"]).cast("date"))


@register("retention_silver", f"""
SELECT * FROM silver_positions
WHERE valuation_date >= DATE '{_AS_OF['silver']}' - INTERVAL 24 MONTH""")
def retention_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.apply_retention(Chain(spark, sf_dir).silver("positions"), "valuation_date",
                                   "silver", F.lit(_AS_OF["silver"]).cast("date"))


@register("retention_gold", f"""
SELECT * FROM fund_nav_daily
WHERE valuation_date >= DATE '{_AS_OF['gold']}' - INTERVAL 84 MONTH""")
def retention_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.apply_retention(Chain(spark, sf_dir).fund_nav_daily, "valuation_date", "gold",
                                   F.lit(_AS_OF["gold"]).cast("date"))


@register("retention_ops", f"""
SELECT {_METRIC_COLS} FROM dq_metrics""", with_fanout_run=True)
def retention_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year after the later run's eve only that run's metrics are left."""
    as_of = F.add_months(F.lit(_RUN_2.date()), 12)
    return reports.apply_retention(_two_runs(spark, sf_dir), "execution_date", "ops",
                                   as_of).drop("execution_date")


# -- publication deadline: two runs, the second republishes all dates --------------
_FIRST_RUN, _SECOND_RUN = dt.datetime(1996, 1, 2, 8, 0), dt.datetime(1998, 3, 2, 8, 30)


@register("sla_freshness", f"""
SELECT valuation_date, published_at, valuation_date + INTERVAL 33 HOUR AS deadline,
       published_at <= valuation_date + INTERVAL 33 HOUR AS sla_met
FROM (SELECT DISTINCT valuation_date,
             CASE WHEN valuation_date < TIMESTAMP '{_FIRST_RUN}' THEN TIMESTAMP '{_FIRST_RUN}'
                  ELSE TIMESTAMP '{_SECOND_RUN}' END AS published_at
      FROM fund_nav_daily)""")
def sla_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First publication against the deadline: the first run knows the dates before it."""
    nav = Chain(spark, sf_dir).fund_nav_daily
    early = reports.record_publications(nav.where(F.col("valuation_date") < F.lit(_FIRST_RUN)),
                                        F.lit(_FIRST_RUN))
    return reports.sla_freshness(reports.record_publications(nav, F.lit(_SECOND_RUN), early))


# -- health of single rules: all three labels occur --------------------------------
def _rule_health_sql() -> str:
    label = "CASE " + " ".join(f"WHEN dq_score >= {b} THEN '{name}'"
                               for b, name in HEALTH_THRESHOLDS) + f" ELSE '{HEALTH_FALLBACK}' END"
    parts = [f"""
SELECT '{spec.name}' AS dataset, c.code AS dq_issue,
       count(*) - count(*) FILTER (list_contains(v.dq_issues, c.code)) AS passed_records,
       count(*) AS n
FROM val_{spec.name} v, (SELECT unnest([{', '.join(f"'{r.code}'" for r in spec.rules)}]) AS code) c
GROUP BY c.code""" for spec in DATASETS.values()]
    return f"""
SELECT dataset, dq_issue, passed_records, dq_score, {label} AS health_status
FROM (SELECT *, round(CAST(passed_records AS DOUBLE) / n * 100, 2) AS dq_score
      FROM ({' UNION ALL '.join(parts)}))"""


@register("rule_health", _rule_health_sql())
def rule_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Chain(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        ops.rule_health(n, c.validated(n), [r.code for r in spec.rules])
        for n, spec in DATASETS.items()])


@register("investor_positions_masked", """
SELECT investor_id, sha256(investor_name) AS investor_name_hash, country, risk_profile,
       investor_type, fund_id, fund_name, fund_type, manager, valuation_date, currency,
       market_value, units, position_count
FROM investor_positions""")
def investor_positions_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.mask_investor_names(Chain(spark, sf_dir).investor_positions)


# -- raw files with lines of too few and of too many cells --------------------------
def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of the fixture that the stand-in file cuts short, or gives a cell too many.
_SHORT = "coalesce(right(asset_id, 1) = '7' AND right(price_date, 1) IN ('1', '5'), false)"
_LONG = "coalesce(right(asset_id, 1) = '3' AND right(price_date, 1) IN ('2', '6'), false)"
_CELLS = [f"coalesce({c}, '')" for c in MARKET_PRICES.bronze_columns]
_LINE = (" || ',' || ".join(_CELLS[:-1])
         + f" || CASE WHEN {_SHORT} THEN '' ELSE ',' || {_CELLS[-1]} END"
         + f" || CASE WHEN {_LONG} THEN ',more' ELSE '' END")
_RAGGED = ["asset_id", "fund_id", "price_date_raw", "currency", "key_count", "dq_issues"]


@register("quarantine_malformed_lines", f"""
SELECT {', '.join(_RAGGED[:-1])}, array_to_string(dq_issues, ',') AS dq_issues,
       CAST(NULL AS VARCHAR) AS raw_line FROM quarantine_market_prices
UNION ALL
SELECT {', '.join(f'NULL AS {c}' for c in _RAGGED[:-1])}, 'MALFORMED_LINE' AS dq_issues,
       {_LINE} AS raw_line
FROM ({{rows}}) WHERE {_SHORT} OR {_LONG}""".replace("{rows}", ADAPTER_SQL["market_prices"]),
          bronze={"market_prices": f"SELECT * FROM ({{rows}}) WHERE NOT ({_SHORT} OR {_LONG})"})
def quarantine_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine of market prices read from CSV files some of whose lines do not fit."""
    chain, root = Chain(spark, sf_dir), _scratch(spark, "ragged")
    # No line holds the separator given, so that lines are written as they are.
    (chain.bronze["market_prices"].select(F.expr(_LINE).alias(
        ",".join(MARKET_PRICES.bronze_columns)))
     .write.options(header="true", sep="\x01", ignoreLeadingWhiteSpace="false",
                    ignoreTrailingWhiteSpace="false").csv(root))
    raw = read_bronze_csv(spark, root, MARKET_PRICES, keep_malformed=True)
    refs = {r.dataset: chain.reference(r.dataset) for r in MARKET_PRICES.references}
    rows = quarantine_rows(validate(raw, MARKET_PRICES, refs, prepared=True))
    return issues_as_text(rows).select(*_RAGGED, "raw_line")


# -- one commit path of streams, batches and retention ------------------------------
@register("bronze_ingest_retain", f"""
SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in POSITIONS.bronze_columns)}
FROM bronze_positions
WHERE coalesce(currency <> 'EUR', true)
   OR coalesce(try_strptime(trim(valuation_date), '%Y-%m-%d')
               >= DATE '{_AS_OF['bronze']}' - INTERVAL 90 DAY, true)""")
def bronze_ingest_retain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in euro are loaded, aged, then the others loaded; repeats add nothing."""
    rows, root = Chain(spark, sf_dir).bronze["positions"], _scratch(spark, "ingest-retain")
    lake = Lakehouse(f"{root}/lake")
    euro = F.coalesce(F.col("currency") == "EUR", F.lit(False))

    def ingest() -> None:
        ingest_table(spark, f"{root}/raw/*", POSITIONS, lake, f"{root}/checkpoint")

    write_bronze_csv(rows.where(euro), f"{root}/raw/first")
    ingest()
    lake.delete_where(spark, "bronze", "positions", reports.aged(
        lake.read(spark, "bronze", "positions"), "valuation_date", "bronze",
        F.lit(_AS_OF["bronze"]).cast("date")))
    write_bronze_csv(rows.where(~euro), f"{root}/raw/second")
    ingest()
    ingest()
    return lake.read(spark, "bronze", "positions").select(*POSITIONS.bronze_columns)


@register("retention_by_day", f"""
SELECT * FROM silver_positions
WHERE valuation_date >= DATE '{_AS_OF['silver']}' - INTERVAL 24 MONTH""")
def retention_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver positions divided by day after the folders of their aged days are dropped."""
    lake = Lakehouse(_scratch(spark, "by-day"), days=pipeline.DAYS)
    lake.write(Chain(spark, sf_dir).silver("positions"), "silver", "positions")
    cutoff = spark.range(1).select(reports.retention_cutoff(
        F.lit(_AS_OF["silver"]).cast("date"), "silver")).first()[0]
    lake.drop_days(spark, "silver", "positions", cutoff)
    return lake.read(spark, "silver", "positions")


@register("gold_refresh", "SELECT 'allocation' AS part, fund_id, valuation_date, currency, "
          "asset_class, market_value, total_market_value, allocation_pct, "
          "NULL AS investor_count FROM asset_allocation UNION ALL "
          "SELECT 'nav', fund_id, valuation_date, currency, NULL, nav_amount, NULL, NULL, "
          "investor_count FROM fund_nav_daily")
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold facts of positions after the rows of late years, and late rows of early days,
    are appended to silver and the gold of their days is made anew."""
    chain = Chain(spark, sf_dir)
    lake = Lakehouse(_scratch(spark, "refresh"), days={
        k: c for k, c in pipeline.DAYS.items() if c == "valuation_date"})
    timer = pipeline.Timer(workers=4)
    # All positions wait in a table that is not divided by day: silver gets each row once.
    timer.wave({f"silver_{n}": (lambda n=n, rows=chain.silver(n): lake.write(
        rows, "incoming" if n == "positions" else "silver", n)) for n in DATASETS})
    rows = lake.read(spark, "incoming", "positions")
    late = (F.col("valuation_date") >= "1997-06-01") | (
        (F.col("valuation_date") < "1992-06-01") & (F.col("asset_class") == "Bond"))
    timer.wave({
        "arrivals": lambda: lake.write(rows.where(late), "arrivals", "positions"),
        "rest": lambda: lake.write(rows.where(~late), "silver", "positions")})
    now = pipeline.run_timestamp()
    pipeline.build_gold(spark, lake, now, timer)
    arrived = lake.read(spark, "arrivals", "positions")
    lake.write(arrived, "silver", "positions", mode="append")
    pipeline.refresh_gold(spark, lake, now, positions=arrived, timer=timer)
    allocation = lake.read(spark, "gold", "asset_allocation").select(
        F.lit("allocation").alias("part"), "fund_id", "valuation_date", "currency", "asset_class",
        "market_value", "total_market_value", "allocation_pct",
        F.lit(None).cast("long").alias("investor_count"))
    nav = lake.read(spark, "gold", "fund_nav_daily").select(
        F.lit("nav").alias("part"), "fund_id", "valuation_date", "currency",
        F.lit(None).cast("string").alias("asset_class"), F.col("nav_amount").alias("market_value"),
        F.lit(None).cast("decimal(38,2)").alias("total_market_value"),
        F.lit(None).cast(allocation.schema["allocation_pct"].dataType).alias("allocation_pct"),
        "investor_count")
    return allocation.unionByName(nav)


# -- counts taken while rows are written --------------------------------------------
@register("dq_counts_observed", """
SELECT dataset, dq_issue, issue_count FROM dq_issue_summary
UNION ALL SELECT dataset, '(total)', total_records FROM dq_metrics
UNION ALL SELECT dataset, '(valid)', valid_records FROM dq_metrics
UNION ALL SELECT dataset, '(invalid)', invalid_records FROM dq_metrics""")
def dq_counts_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and issue summary of a run whose counts come from the jobs that write."""
    lake, timer = Lakehouse(_scratch(spark, "observed")), pipeline.Timer(workers=4)
    pipeline.ingest_bronze(lake, Chain(spark, sf_dir).bronze, timer)
    counts = pipeline.build_silver(spark, lake, pipeline.run_timestamp(), timer=timer)
    pipeline.build_ops(spark, lake, timer, counts=counts)
    metrics = lake.read(spark, "ops", "dq_metrics")
    return reduce(DataFrame.unionByName, [lake.read(spark, "ops", "dq_issue_summary")] + [
        metrics.select("dataset", F.lit(f"({c})").alias("dq_issue"),
                       F.col(f"{c}_records").alias("issue_count"))
        for c in ("total", "valid", "invalid")])


# -- distinct investors over any days, from daily sets ------------------------------
_RANGES = {"1995": ("1995-01-01", "1995-12-31"), "first half of 1996": ("1996-01-01", "1996-06-30"),
           "all": ("0001-01-01", "9999-12-31")}


@register("investors_between", " UNION ALL ".join(f"""
SELECT '{name}' AS days, fund_id, currency, count(DISTINCT investor_id) AS investor_count
FROM silver_positions WHERE valuation_date BETWEEN DATE '{a}' AND DATE '{b}'
GROUP BY fund_id, currency""" for name, (a, b) in _RANGES.items()))
def investors_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct investors per fund and currency over ranges of days; the positions are
    validated once and read in two loads, and the ranges are counted from the daily sets."""
    lake = Lakehouse(_scratch(spark, "sets"))
    lake.write(Chain(spark, sf_dir).silver("positions").select(*distinct.GROUP, "investor_id"),
               "silver", "positions")
    positions = lake.read(spark, "silver", "positions")
    early = F.col("valuation_date") < "1996-03-01"
    for part in (positions.where(early), positions.where(~early)):
        known = lake.read(spark, "gold", "investor_codes") \
            if lake.exists(spark, "gold", "investor_codes") else None
        lake.write(distinct.number_ids(part, known=known), "gold", "investor_codes", "append")
        lake.write(distinct.daily_sets(part, lake.read(spark, "gold", "investor_codes")),
                   "gold", "investor_sets", "append")
    sets = lake.read(spark, "gold", "investor_sets")
    return reduce(DataFrame.unionByName, [
        distinct.distinct_ids(sets.where(F.col("valuation_date").between(a, b)),
                              ["fund_id", "currency"]).select(F.lit(name).alias("days"), "*")
        for name, (a, b) in _RANGES.items()])


# -- validation load by load ---------------------------------------------------------
def _loads_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Silver and quarantine of a dataset after its raw rows, and those of the tables
        that it refers to, came in three loads (dealt row by row, so that copies of a key
        and ids come late)."""
        root = _scratch(spark, "loads")
        lake, chain, now = Lakehouse(f"{root}/lake"), Chain(spark, sf_dir), pipeline.run_timestamp()
        names = [*(r.dataset for r in DATASETS[name].references), name]
        for n in names:
            (chain.bronze[n].withColumn("part", F.monotonically_increasing_id() % 3)
             .write.partitionBy("part").parquet(f"{root}/raw/{n}"))
        for load in range(3):
            loads.apply_load(spark, lake, load, {
                n: spark.read.parquet(f"{root}/raw/{n}").where(F.col("part") == load).drop("part")
                for n in names}, now, buckets=8)
        valid = lake.read(spark, "silver", name).drop("processed_at")
        invalid = issues_as_text(lake.read(spark, "ops", f"dq_{name}_quarantine"))
        return valid.withColumn("layer", F.lit("silver")).unionByName(
            invalid.drop("quarantined_at").withColumn("layer", F.lit("quarantine")),
            allowMissingColumns=True)
    return q


for _name in ("transactions", "market_prices"):
    register(f"loads_{_name}", f"""
SELECT *, 'silver' AS layer FROM silver_{_name}
UNION ALL BY NAME
SELECT *, 'quarantine' AS layer FROM ({oracle.quarantine_select(DATASETS[_name])})""")(
        _loads_query(_name))


# -- price outliers by median and median absolute deviation --------------------------
def _robust_sql(table: str) -> str:
    return f"""
SELECT * FROM (WITH m AS (SELECT asset_id, currency, quantile_disc(close_price, 0.5) AS median_price
           FROM {table} GROUP BY asset_id, currency HAVING count(close_price) >= 3),
     d AS (SELECT p.*, m.median_price, abs(p.close_price - m.median_price) AS deviation
           FROM {table} p JOIN m ON p.asset_id = m.asset_id AND p.currency = m.currency),
     s AS (SELECT asset_id, currency, quantile_disc(deviation, 0.5) AS mad
           FROM d GROUP BY asset_id, currency)
SELECT d.asset_id, d.fund_id, d.price_date, d.currency, d.close_price, d.median_price, s.mad
FROM d JOIN s ON d.asset_id = s.asset_id AND d.currency = s.currency
WHERE 10000 * CAST(d.deviation AS DECIMAL(28,4)) > 51891 * CAST(s.mad AS DECIMAL(28,4)))"""


@register("price_outliers_robust", _robust_sql("silver_market_prices"))
def price_outliers_robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.price_outliers_robust(Chain(spark, sf_dir).silver("market_prices"))


@register("price_outliers_robust_dense", _robust_sql(
    f"({_PART_PRICES.replace('{part}', 'part')})"))
def price_outliers_robust_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.price_outliers_robust(
        spark.sql(_PART_PRICES, part=spark.read.parquet(f"{sf_dir}/part.parquet")))


# -- investors published under keyed pseudonyms and in groups of at least k ----------
_K = 5
_SECRET = "registered query"  # stands for the session's secret; the oracle needs it too


def _hmac_sql(column: str, secret: str) -> str:
    block = secret.encode().ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in block).hex() for pad in (0x36, 0x5C))
    return (f"sha256(from_hex('{outer}') || from_hex(sha256(from_hex('{inner}') "
            f"|| encode({column}))))")


def _generalised_sql() -> str:
    """Each step publishes the groups of at least k among the investors left over."""
    ctes, left = [], "people"
    for i, hidden in enumerate(reports.GENERALISATION):
        cols = ", ".join(f"'*' AS {c}" if c in hidden else c for c in reports.QUASI_IDENTIFIERS)
        ctes.append(f"g{i} AS (SELECT id, {cols} FROM {left})")
        ctes.append(f"n{i} AS (SELECT *, count(*) OVER (PARTITION BY "
                    f"{', '.join(reports.QUASI_IDENTIFIERS)}) AS group_size FROM g{i})")
        ctes.append(f"l{i} AS (SELECT p.* FROM {left} p JOIN n{i} USING (id) "
                    f"WHERE group_size < {_K})")
        left = f"l{i}"
    steps = range(len(reports.GENERALISATION))
    published = " UNION ALL ".join(
        f"SELECT * FROM n{i} WHERE group_size >= {_K}" for i in steps)
    return f"""
SELECT * FROM (WITH people AS (SELECT id, country, risk_profile, investor_type FROM silver_investors),
{', '.join(ctes)}
SELECT {_hmac_sql('id', _SECRET)} AS investor_pseudonym, {', '.join(reports.QUASI_IDENTIFIERS)},
       group_size
FROM ({published}))"""


@register("investors_k_anonymous", _generalised_sql())
def investors_k_anonymous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.k_anonymous_investors(Chain(spark, sf_dir).silver("investors"), _SECRET, _K)
