"""Property test: Spark validation agrees with a plain-Python model of the rules.

Random raw transaction rows (small alphabets, so repeated ids, unknown
references, blanks and NULLs are common) are validated by Spark and by the
model below; the issue lists must be equal row for row, and the split must add
up to the input.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from navforge.operators.quality import prepare_reference, validate
from navforge.specs import CURRENCIES, TRANSACTION_TYPES, TRANSACTIONS

IDS = st.sampled_from(["T1", "T2", " T3 ", "T4", "", "  ", None])
FUNDS = st.sampled_from(["F1", "F2", "F9", " F1", "", None])
INVESTORS = st.sampled_from(["I1", "I2", "I7", "", None])
DATES = st.sampled_from(["2024-01-15", " 2024-03-01 ", "2024-02-30", "15/01/2024", "2024-1-5",
                         "", None])
TYPES = st.sampled_from(list(TRANSACTION_TYPES) + ["Fee", " Switch", "", None])
AMOUNTS = st.sampled_from(["10.00", "12.345", "0", "-5", "abc", "1e3", "", None, " 7.5 "])
CCY = st.sampled_from(list(CURRENCIES) + ["GBP", "", None])
ROW = st.tuples(IDS, FUNDS, INVESTORS, DATES, TYPES, AMOUNTS, CCY)

VALID_FUNDS = {"F1", "F2"}
VALID_INVESTORS = {"I1", "I2"}


def _trim(v):
    return None if v is None else v.strip(" ")


def _date(v):
    if v is None or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", v):
        return None
    try:
        return dt.date.fromisoformat(v)
    except ValueError:
        return None


def _amount(v):
    if v is None or v == "":
        return None
    try:
        d = Decimal(v)
    except InvalidOperation:
        return None
    q = d.quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    return q if len(q.as_tuple().digits) - max(0, -q.as_tuple().exponent) <= 16 else None


def model(rows):
    trimmed = [tuple(_trim(v) for v in r) for r in rows]
    counts = Counter(r[0] for r in trimmed if r[0] is not None)
    out = []
    for i, f, inv, d, typ, amt, ccy in trimmed:
        a = _amount(amt)
        codes = []
        if i is None or i == "":
            codes.append("MISSING_TRANSACTION_ID")
        if i is not None and counts[i] > 1:
            codes.append("DUPLICATE_TRANSACTION_ID")
        if f is None or f == "":
            codes.append("MISSING_FUND_ID")
        if inv is None or inv == "":
            codes.append("MISSING_INVESTOR_ID")
        if f not in VALID_FUNDS:
            codes.append("UNKNOWN_FUND_ID")
        if inv not in VALID_INVESTORS:
            codes.append("UNKNOWN_INVESTOR_ID")
        if _date(d) is None:
            codes.append("INVALID_TRANSACTION_DATE")
        if typ is not None and typ not in TRANSACTION_TYPES:
            codes.append("INVALID_TRANSACTION_TYPE")
        if a is None:
            codes.append("INVALID_AMOUNT")
        if a is not None and a <= 0:
            codes.append("NON_POSITIVE_AMOUNT")
        if ccy is not None and ccy not in CURRENCIES:
            codes.append("INVALID_CURRENCY")
        out.append(codes)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=25))
def test_validation_matches_python_model(spark, rows):
    schema = ",".join(f"{c} string" for c in TRANSACTIONS.bronze_columns)
    bronze = spark.createDataFrame(rows, schema)
    funds = spark.createDataFrame([("F1",), ("F2",), ("F2",)], "id string")
    investors = spark.createDataFrame([("I1",), ("I2",)], "id string")
    refs = {"funds": prepare_reference(funds), "investors": prepare_reference(investors)}
    v = validate(bronze, TRANSACTIONS, refs, prepared=True)
    # validate keeps every input row exactly once (references are de-duplicated)
    assert v.count() == len(rows)
    got = sorted(tuple(r["dq_issues"]) for r in v.collect())
    want = sorted(tuple(c) for c in model(rows))
    assert got == want
