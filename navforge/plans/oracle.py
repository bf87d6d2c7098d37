"""DuckDB oracle: the same queries as plain SQL, for the correctness check.

The bronze fixtures use the very same adapter SQL as Spark.  Validation is
re-expressed independently: rule kinds render to SQL predicates, the key count
is the full ``GROUP BY`` joined back, references are ``SELECT DISTINCT`` ids.
Result types are cast to Spark's (``sum`` of DECIMAL(18,2) is DECIMAL(28,2) in
Spark, DECIMAL(38,2) in DuckDB), arrays are compared as comma-joined text and
audit timestamps are left out on both sides.
"""

from __future__ import annotations

from navforge.sources.fixtures import ADAPTER_SQL
from navforge.specs import (
    API_VERSION, DATASETS, HEALTH_FALLBACK, HEALTH_THRESHOLDS, Allowed, Bound, DatasetSpec,
    Known, Parsed, Required, Unique,
)


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _predicate(rule) -> str:
    if isinstance(rule, Allowed):
        return f"{rule.column} NOT IN ({', '.join(_q(v) for v in rule.values)})"
    if isinstance(rule, Required):
        return f"({rule.column} IS NULL OR {rule.column} = '')"
    if isinstance(rule, Parsed):
        return f"{rule.column} IS NULL"
    if isinstance(rule, Bound):
        return f"{rule.column} {rule.op} {rule.value}"
    if isinstance(rule, Unique):
        return f"{rule.count_column} > 1"
    if isinstance(rule, Known):
        return f"{rule.ref_column} IS NULL"
    raise TypeError(rule)


def _dataset_ctes(spec: DatasetSpec, dedupe_refs: bool, p: str = "") -> list[tuple[str, str]]:
    n = spec.name
    trims = ", ".join(f"trim({c}) AS {spec.rename.get(c, c)}" for c in spec.bronze_columns)
    extra = [f"try_strptime({d.raw}, '%Y-%m-%d') AS {d.parsed}" for d in spec.dates]
    for d in spec.decimals:
        raw = f"replace({d.raw}, ',', '.')" if d.decimal_comma else d.raw
        extra.append(f"TRY_CAST({raw} AS DECIMAL({d.precision},{d.scale})) AS {d.out}")
    ctes = [(f"{p}std_{n}", f"SELECT {trims} FROM bronze_{n}"),
            (f"{p}prs_{n}", f"SELECT *, {', '.join(extra)} FROM {p}std_{n}")]
    cur = f"{p}prs_{n}"
    if spec.key:
        keys = ", ".join(spec.key)
        on = " AND ".join(f"b.{k} = c.{k}" for k in spec.key)
        ctes.append((f"{p}cnt_{n}", f"SELECT {keys}, count(*) AS {spec.count_column} "
                                 f"FROM {cur} GROUP BY {keys}"))
        ctes.append((f"{p}key_{n}", f"SELECT b.*, c.{spec.count_column} FROM {cur} b "
                                 f"LEFT JOIN {p}cnt_{n} c ON {on}"))
        cur = f"{p}key_{n}"
    for i, ref in enumerate(spec.references):
        distinct = "DISTINCT " if dedupe_refs else ""
        ctes.append((f"{p}ref{i}_{n}", f"SELECT b.*, r.{ref.out} FROM {cur} b LEFT JOIN "
                                    f"(SELECT {distinct}id AS {ref.out} FROM {p}silver_{ref.dataset}) r "
                                    f"ON b.{ref.column} = r.{ref.out}"))
        cur = f"{p}ref{i}_{n}"
    cases = ", ".join(f"CASE WHEN {_predicate(r)} THEN {_q(r.code)} END" for r in spec.rules)
    ctes.append((f"{p}val_{n}", f"SELECT *, list_filter([{cases}], lambda x: x IS NOT NULL) "
                             f"AS dq_issues FROM {cur}"))
    dates = [f"CAST({d.parsed} AS DATE) AS {d.out}" for d in spec.dates]
    keep = silver_columns(spec)[:-len(dates) or None]
    ctes.append((f"{p}silver_{n}", f"SELECT {', '.join(keep + dates)} FROM {p}val_{n} "
                                f"WHERE len(dq_issues) = 0"))
    ctes.append((f"{p}quarantine_{n}", f"SELECT * FROM {p}val_{n} WHERE len(dq_issues) > 0"))
    return ctes


def validated_columns(spec: DatasetSpec) -> list[str]:
    cols = spec.trimmed_columns + [d.parsed for d in spec.dates] + [d.out for d in spec.decimals]
    if spec.count_column:
        cols.append(spec.count_column)
    cols += [r.out for r in spec.references]
    return cols + ["dq_issues"]


def silver_columns(spec: DatasetSpec) -> list[str]:
    helpers = {*spec.helper_columns, "dq_issues"}
    return [c for c in validated_columns(spec) if c not in helpers] + [d.out for d in spec.dates]


def _gold_ctes() -> list[tuple[str, str]]:
    # A fact joins every silver row with its id; facts are aggregated after the join.
    fund = "f.name AS fund_name, f.type AS fund_type, f.manager"
    of_fund = "LEFT JOIN silver_funds f ON f.id = t.fund_id"
    return [
        ("fund_nav_daily", f"""
WITH t AS (SELECT fund_id, valuation_date, currency,
                  CAST(sum(market_value) AS DECIMAL(28,2)) AS nav_amount,
                  count(DISTINCT investor_id) AS investor_count, count(*) AS position_count
           FROM silver_positions GROUP BY ALL)
SELECT t.*, {fund} FROM t {of_fund}"""),
        ("investor_positions", f"""
SELECT t.investor_id, i.name AS investor_name, i.country, i.risk_profile, i.investor_type,
       t.fund_id, {fund}, t.valuation_date, t.currency,
       CAST(sum(t.market_value) AS DECIMAL(28,2)) AS market_value,
       CAST(sum(t.units) AS DECIMAL(28,4)) AS units, count(*) AS position_count
FROM silver_positions t {of_fund} LEFT JOIN silver_investors i ON i.id = t.investor_id
GROUP BY ALL"""),
        ("fund_cashflows", f"""
SELECT t.fund_id, {fund}, t.transaction_date, t.transaction_type, t.currency,
       CAST(sum(t.amount) AS DECIMAL(28,2)) AS total_amount, count(*) AS transaction_count,
       count(DISTINCT t.investor_id) AS investor_count
FROM silver_transactions t {of_fund} GROUP BY ALL"""),
        ("allocation_base", f"""
SELECT t.fund_id, {fund}, t.valuation_date, t.asset_class, t.currency,
       CAST(sum(t.market_value) AS DECIMAL(28,2)) AS market_value
FROM silver_positions t {of_fund} GROUP BY ALL"""),
        ("allocation_totals", """
SELECT fund_id, valuation_date, currency,
       CAST(sum(market_value) AS DECIMAL(38,2)) AS total_market_value
FROM allocation_base GROUP BY ALL"""),
        # Spark rounds decimal division in three stages (scale 10, then 6, then 2);
        # replay them on integer cents so no double rounding sneaks in.
        ("asset_allocation", """
SELECT b.fund_id, b.valuation_date, b.currency, b.fund_name, b.fund_type, b.manager,
       b.asset_class, b.market_value, t.total_market_value,
       CASE WHEN t.total_market_value <> 0 THEN CAST(CAST(
         ((((2 * CAST(b.market_value * 100 AS HUGEINT) * 10000000000
              + CAST(t.total_market_value * 100 AS HUGEINT))
             // (2 * CAST(t.total_market_value * 100 AS HUGEINT)) + 50) // 100 + 5000) // 10000)
         AS DECIMAL(35,0)) * 0.01 AS DECIMAL(35,2)) END AS allocation_pct
FROM allocation_base b
LEFT JOIN allocation_totals t
  ON b.fund_id = t.fund_id AND b.valuation_date = t.valuation_date
 AND b.currency = t.currency"""),
        ("latest_nav", """
SELECT fund_id, valuation_date, currency, nav_amount, investor_count, position_count
FROM fund_nav_daily
QUALIFY rank() OVER (PARTITION BY fund_id ORDER BY valuation_date DESC) = 1"""),
        ("latest_cashflow_date", """
SELECT fund_id, max(transaction_date) AS latest_transaction_date
FROM silver_transactions GROUP BY fund_id"""),
        ("api_fund_summary", f"""
SELECT f.id AS fund_id, f.name AS fund_name, f.type AS fund_type, f.currency AS base_currency,
       f.status, f.domicile, f.manager, f.risk_level, n.valuation_date, n.currency,
       n.nav_amount, n.investor_count, n.position_count, c.latest_transaction_date,
       {_q(API_VERSION)} AS api_version
FROM silver_funds f
LEFT JOIN latest_nav n ON f.id = n.fund_id
LEFT JOIN latest_cashflow_date c ON f.id = c.fund_id"""),
    ]


def _metrics_sql(p: str = "") -> str:
    parts = []
    for n in DATASETS:
        parts.append(f"""
SELECT {_q(n)} AS dataset,
       (SELECT count(*) FROM bronze_{n}) AS total_records,
       (SELECT count(*) FROM {p}val_{n} WHERE len(dq_issues) = 0) AS valid_records,
       (SELECT count(*) FROM {p}val_{n} WHERE len(dq_issues) > 0) AS invalid_records""")
    return ("SELECT dataset, total_records, valid_records, invalid_records, "
            "round(CAST(valid_records AS DOUBLE) / total_records * 100, 2) AS dq_score "
            "FROM (" + " UNION ALL ".join(parts) + ")")


def _ops_ctes() -> list[tuple[str, str]]:
    metrics = _metrics_sql()
    issues = " UNION ALL ".join(
        f"SELECT {_q(n)} AS dataset, unnest(dq_issues) AS dq_issue FROM quarantine_{n}"
        for n in DATASETS)
    health = "CASE " + " ".join(f"WHEN dq_score >= {b} THEN {_q(label)}"
                                for b, label in HEALTH_THRESHOLDS)
    health += f" ELSE {_q(HEALTH_FALLBACK)} END"
    return [
        ("dq_metrics", metrics),
        ("dq_issue_summary", f"SELECT dataset, dq_issue, count(*) AS issue_count FROM ({issues}) "
                             "GROUP BY dataset, dq_issue"),
        ("dq_latest_summary", "SELECT * FROM dq_metrics"),
        ("pipeline_health", f"SELECT *, {health} AS health_status FROM dq_latest_summary"),
    ]


# Prefix of the second chain that keeps the reference's join fan-out.
FANOUT = "fo_"


def chain_ctes(dedupe_refs: bool = True, with_fanout_run: bool = False,
               bronze: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """``bronze``: other raw rows of a dataset, as SQL over its usual ones (``{rows}``)."""
    ctes = [(f"bronze_{n}", (bronze or {}).get(n, "{rows}").replace(
        "{rows}", ADAPTER_SQL[n].strip())) for n in DATASETS]
    for spec in DATASETS.values():
        ctes += _dataset_ctes(spec, dedupe_refs)
    ctes += _gold_ctes() + _ops_ctes()
    if with_fanout_run:
        for spec in DATASETS.values():
            ctes += _dataset_ctes(spec, False, FANOUT)
        ctes.append((f"{FANOUT}dq_metrics", _metrics_sql(FANOUT)))
    return ctes


def with_chain(select: str, dedupe_refs: bool = True, with_fanout_run: bool = False,
               bronze: dict[str, str] | None = None) -> str:
    body = ",\n".join(f"{name} AS (\n{sql.strip()}\n)"
                      for name, sql in chain_ctes(dedupe_refs, with_fanout_run, bronze))
    return f"WITH {body}\n{select.strip()}"


def quarantine_select(spec: DatasetSpec) -> str:
    cols = [c if c != "dq_issues" else "array_to_string(dq_issues, ',') AS dq_issues"
            for c in validated_columns(spec)]
    return f"SELECT {', '.join(cols)} FROM quarantine_{spec.name}"


def standardize_select(spec: DatasetSpec) -> str:
    return f"SELECT * FROM prs_{spec.name}"
