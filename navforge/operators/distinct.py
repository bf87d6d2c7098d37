"""Distinct investors as sets that can be merged.

A count of distinct investors cannot be added up over days.  Here each group of a
fact keeps its set instead: investors are numbered once, and a set is bits over these
numbers, in words of 64: only words that hold a bit are kept, so that a set of few ids
takes a row or so for each, never more rows than ids, and a dense one a row for 64.
Sets of any days are merged by OR and counted exactly, without the positions being read
again.  Both aggregates are hash aggregates of fixed width, combined map-side, so a fund
that holds most rows costs one partial set a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navforge.operators.joins import lookup_join, size_side, unsized

#: Group of the daily sets.
GROUP = ("fund_id", "valuation_date", "currency")


def number_ids(rows: DataFrame, column: str = "investor_id",
               known: DataFrame | None = None) -> DataFrame:
    """(``column``, code) for the ids of ``rows`` that ``known`` does not number yet.

    Codes are unique, and consecutive within each partition of the ids; the result must
    be written before it is used, as a recomputed one may number anew.  New codes begin
    after the largest known one.
    """
    ids = rows.select(column).where(F.col(column).isNotNull()).distinct()
    start = 0
    if known is not None:
        ids = ids.join(known, column, "left_anti")
        last = known.agg(F.max("code")).first()[0]
        start = 0 if last is None else last + 1
    return ids.select(column, (F.monotonically_increasing_id() + start).alias("code"))


def daily_sets(rows: DataFrame, codes: DataFrame, group: Sequence[str] = GROUP,
               column: str = "investor_id", measured: bool = True) -> DataFrame:
    """Per group and word of codes the set of ids (null ids count in none)."""
    pairs = rows.where(F.col(column).isNotNull()).select(*group, column)
    side = size_side(codes) if measured else unsized(codes)
    coded = lookup_join(pairs, side, [column], "inner", counts=(
        pairs.groupBy(column).agg(F.count(F.lit(1)).alias("n"))))
    return coded.groupBy(*group, F.shiftright("code", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(code & 63 as int))")).alias("investors"))


def distinct_ids(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact distinct counts of any coarser group, from the sets alone."""
    words = sets.groupBy(*by, "word").agg(F.bit_or("investors").alias("investors"))
    return words.groupBy(*by).agg(F.sum(F.bit_count("investors")).alias("investor_count"))
