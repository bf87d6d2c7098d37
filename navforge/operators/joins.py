"""Lookup joins whose right side may or may not be broadcast.

Spark only broadcasts statically when it can estimate a side's size (file
statistics of a written table).  Sides derived inside the same job (an
aggregate of the fact table, a distinct of a dimension) have no trustworthy
estimate, and AQE decides only after *both* join inputs have been shuffled — so
the large side is shuffled anyway.  ``size_side`` measures the exact row count
and payload of such a side first (one aggregate job, nothing is kept) and hints
a broadcast only under both bounds.

Beyond the bounds ``split_join`` treats the keys by what they are: rows of hot
keys join a size-checked broadcast of those keys' right-hand rows, so a key
that holds a third of all rows is never gathered; rows whose key has a NULL
part match nothing and bypass the join; all others meet in a shuffle join.
Which way a row goes depends on its key alone, so a retried task routes alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navforge.sources.staging import staged

# Broadcast bound: rows are shipped to every executor, so keep it modest.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_BROADCAST_ROWS = 4_000_000
# Keys with more rows than this are joined by broadcast in a split join.
DEFAULT_HOT_KEY_ROWS = 1_000_000


@dataclass(frozen=True)
class SizedSide:
    """The right side of lookups: ``frame`` carries the hint when ``broadcast``."""

    frame: DataFrame
    rows: int | None
    payload_bytes: int | None
    broadcast: bool
    checked: bool = True  # False: size unknown, the join is left to Spark


def measure(df: DataFrame) -> tuple[int, int]:
    """Exact (rows, payload bytes) of ``df`` in one aggregate job."""
    width = F.lit(0)
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        size = F.octet_length(c.cast("string")) if field.dataType.typeName() != "string" \
            else F.octet_length(c)
        width = width + F.coalesce(size, F.lit(0)) + F.lit(8)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def conf_int(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def fits_broadcast(df: DataFrame, rows: int, payload: int) -> bool:
    return (rows <= conf_int(df, "navforge.broadcast.maxRows", DEFAULT_BROADCAST_ROWS)
            and payload <= conf_int(df, "navforge.broadcast.maxBytes", DEFAULT_BROADCAST_BYTES))


def size_side(df: DataFrame) -> SizedSide:
    """Measure ``df``; hint a broadcast under the session's bounds
    ``navforge.broadcast.maxBytes`` and ``navforge.broadcast.maxRows``."""
    rows, payload = measure(df)
    small = fits_broadcast(df, rows, payload)
    return SizedSide(F.broadcast(df) if small else df, rows, payload, small)


def unsized(df: DataFrame) -> SizedSide:
    return SizedSide(df, None, None, broadcast=False, checked=False)


def all_not_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def lookup_join(left: DataFrame, side: SizedSide, key: Sequence[str], how: str = "left",
                counts: DataFrame | None = None) -> DataFrame:
    """``left <how> JOIN side USING (key)`` for how = left or inner.

    ``counts`` (key columns and ``n``) may give how often keys occur in
    ``left``; without it a narrow aggregate over ``left`` counts them when needed.
    """
    if side.broadcast or not side.checked:
        return left.join(side.frame, list(key), how)
    return split_join(left, side.frame, key, how, counts)


def split_join(left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "left",
               counts: DataFrame | None = None) -> DataFrame:
    """The join of a ``right`` too large to broadcast; see the module's text.

    ``left`` is written to the shared staging folder first, as its parts are
    read separately.  The bound for hot keys starts at ``navforge.skew.hotKeyRows``
    and grows until the hot keys' right-hand rows fit a broadcast.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"split_join cannot do a {how} join")
    key = list(key)
    left = staged(left, "split-join")
    columns = [*left.columns, *(c for c in right.columns if c not in key)]
    keyed = left.where(all_not_null(key))
    if counts is None:
        counts = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    bound = conf_int(left, "navforge.skew.hotKeyRows", DEFAULT_HOT_KEY_ROWS)
    while True:
        keys = staged(counts.where(F.col("n") > bound).select(*key), "hot-keys")
        hot_keys = size_side(keys)
        if not hot_keys.rows:
            parts = [keyed.join(right, key, how)]
            break
        hot_right = size_side(staged(right.join(keys, key, "left_semi"), "hot-rows"))
        if hot_keys.broadcast and hot_right.broadcast:
            parts = [keyed.join(hot_keys.frame, key, "left_anti").join(right, key, how),
                     keyed.join(hot_keys.frame, key, "left_semi").join(
                         hot_right.frame, key, how)]
            break
        bound *= 4
    if how == "left":
        added = {f.name: F.lit(None).cast(f.dataType) for f in right.schema if f.name not in key}
        parts.append(left.where(~all_not_null(key)).withColumns(added))
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])
