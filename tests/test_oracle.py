"""Every registered query against its DuckDB oracle (row count, columns, values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from navforge.plans import registry
from tests.conftest import SF_SMALL
from tools.compare import digest, duck

ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = registry.queries()[name](spark, SF_SMALL)
    s = digest(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLE[name])
    d = digest(rel.columns, rel.fetchall())
    assert s[0] == d[0], "column names differ"
    assert s[1] == d[1], "row counts differ"
    assert s[2] == d[2], f"values differ: {sorted(set(s[3]) ^ set(d[3]))[:4]}"


def test_every_query_has_an_oracle_or_is_listed():
    without = set(registry.queries()) - set(ORACLE)
    assert not without, without
    assert set(registry.queries()) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "nav_amount" in df.columns
