"""Rule kinds to Spark Columns.

Every rule becomes ``CASE WHEN <violation> THEN '<code>' ELSE '' END``; the codes of
one row are gathered in spec order and the empty ones dropped, so a row carries every
rule it breaks (no short-circuit).
"""

from __future__ import annotations

from functools import singledispatch

from pyspark.sql import Column
from pyspark.sql import functions as F

from navforge.specs import Allowed, Bound, Known, Parsed, Required, Rule, Unique


@singledispatch
def violation(rule) -> Column:  # pragma: no cover - dispatch fallback
    raise TypeError(f"unknown rule kind {type(rule).__name__}")


@violation.register
def _(rule: Allowed) -> Column:
    # NOT IN keeps SQL three-valued logic: NULL is "unknown" and passes.
    return ~F.col(rule.column).isin(list(rule.values))


@violation.register
def _(rule: Required) -> Column:
    c = F.col(rule.column)
    return c.isNull() | (c == F.lit(""))


@violation.register
def _(rule: Parsed) -> Column:
    return F.col(rule.column).isNull()


@violation.register
def _(rule: Bound) -> Column:
    c = F.col(rule.column)
    if rule.op == "<=":
        return c <= F.lit(rule.value)
    if rule.op == "<":
        return c < F.lit(rule.value)
    raise ValueError(f"unsupported bound operator {rule.op!r}")


@violation.register
def _(rule: Unique) -> Column:
    return F.col(rule.count_column) > F.lit(1)


@violation.register
def _(rule: Known) -> Column:
    return F.col(rule.ref_column).isNull()


def issue_codes(rules: tuple[Rule, ...] | list[Rule]) -> Column:
    """``array<string>`` of the codes of all violated rules, in rule order (empty texts for
    the others are removed by a function that Spark compiles, unlike ``array_compact``)."""
    return F.array_remove(F.array(*[
        F.when(violation(r), F.lit(r.code)).otherwise(F.lit("")) for r in rules]), "")
