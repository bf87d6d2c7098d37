"""Write PLANS.md: executed physical plans of the main operators.

    python tools/plans.py [sf_dir] [out.md]

Runs the pipeline once into a scratch lakehouse, then builds each operator on
the written tables, executes it (noop sink) and records the final adaptive
plan tree plus the scan lines (read schema, pushed filters).
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _tree_and_scans(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # runs this very plan, so the adaptive plan below is final
    text = qe.executedPlan().toString()
    lines = [ln for ln in text.splitlines() if ln.strip()]
    return "\n".join(lines)


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")

    from navforge.operators import gold, ops, reports
    from navforge.operators.quality import prepare_reference, validate, valid_rows
    from navforge.plans import pipeline
    from navforge.session import build_session
    from navforge.sources.bronze import fixture_bronze
    from navforge.sources.sinks import Lakehouse
    from navforge.specs import DATASETS, POSITIONS

    spark = build_session(extra={"spark.driver.memory": "16g"})
    lake = Lakehouse(tempfile.mkdtemp(prefix="navforge-plans-"))
    pipeline.run(spark, lake, bronze=fixture_bronze(spark, sf_dir))

    def r(layer: str, table: str):
        return lake.read(spark, layer, table)

    cases = {
        "silver positions (validate + valid split)": lambda: valid_rows(validate(
            r("bronze", "positions"), POSITIONS,
            {"funds": prepare_reference(r("silver", "funds")),
             "investors": prepare_reference(r("silver", "investors"))}, prepared=True),
            POSITIONS),
        "fund_nav_daily": lambda: gold.fund_nav_daily(r("silver", "positions"),
                                                      r("silver", "funds")),
        "investor_positions": lambda: gold.investor_positions(
            r("silver", "positions"), r("silver", "funds"), r("silver", "investors")),
        "fund_cashflows": lambda: gold.fund_cashflows(r("silver", "transactions"),
                                                      r("silver", "funds")),
        "asset_allocation": lambda: gold.asset_allocation(r("silver", "positions"),
                                                          r("silver", "funds")),
        "api_fund_summary": lambda: gold.api_fund_summary(
            r("silver", "funds"), r("gold", "fund_nav_daily"), r("silver", "transactions")),
        "dq_issue_summary": lambda: ops.dq_issue_summary(
            {n: r("ops", f"dq_{n}_quarantine") for n in DATASETS}),
        "dq_latest_summary": lambda: ops.dq_latest_summary(r("ops", "dq_metrics")),
        "price_outliers": lambda: reports.price_outliers(r("silver", "market_prices")),
        "nav_by_manager_top10": lambda: reports.nav_by_manager_top(r("gold", "fund_nav_daily")),
    }
    parts = [
        "# Physical plans\n",
        f"Generated by `tools/plans.py` on `{os.path.basename(sf_dir)}` (local[*], AQE on). Each "
        "operator reads the tables written by the pipeline and is executed; below is "
        "the executed (final adaptive) plan. Nothing is cached.\n",
    ]
    for name, build in cases.items():
        plan = _tree_and_scans(build())
        plan = re.sub(r"file:/[^\]\s,]*/(bronze|silver|gold|ops)/", r"<lake>/\1/", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        parts.append(f"## {name}\n\n```\n{plan}\n```\n")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()
    print(out)


if __name__ == "__main__":
    main(sys.argv)
