"""Silver-layer operators: standardise, key counts, reference checks, validate, split.

``validate(bronze, spec, refs)`` replaces one hand-written notebook per dataset
with a single plan built from a :class:`~navforge.specs.DatasetSpec`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navforge.functions.parse import parse_decimal, parse_timestamp, trimmed
from navforge.functions.rules import issue_codes
from navforge.operators.joins import (
    SizedSide, all_not_null, fits_broadcast, lookup_join, size_side, unsized,
)
from navforge.session import ensure_checkpoint_dir
from navforge.specs import MALFORMED_LINE, RAW_LINE, DatasetSpec

ISSUES = "dq_issues"
_DUP_N = "__dup_n"
_HASH = "__key_hash"


def standardize(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Trim + rename every bronze column, then add parsed dates and decimals.

    Of a malformed line (``raw_line`` not null) every column is NULL: its cells cannot
    be told apart, so that none counts as a key or a reference.
    """
    cells = [trimmed(c, spec.rename.get(c, c)) for c in spec.bronze_columns]
    if RAW_LINE in bronze.columns:
        fits = F.col(RAW_LINE).isNull()
        cells = [F.when(fits, trimmed(c)).alias(spec.rename.get(c, c))
                 for c in spec.bronze_columns] + [F.col(RAW_LINE)]
    base = bronze.select(*cells)
    return base.select(
        "*",
        *[parse_timestamp(d.raw).alias(d.parsed) for d in spec.dates],
        *[parse_decimal(d.raw, d.precision, d.scale, d.decimal_comma).alias(d.out)
          for d in spec.decimals],
    )


def _repeated(keyed: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return (keyed.groupBy(*key).agg(F.count(F.lit(1)).alias(_DUP_N))
            .where(F.col(_DUP_N) > 1))


def _repeated_sized(keyed: DataFrame, key: tuple[str, ...]) -> tuple[DataFrame, SizedSide]:
    """Keys that occur more than once, with their counts, and the same sized for a join.

    The keys' 64-bit hashes are counted first, so that one narrow row a key is shuffled
    and once only; keys are then counted exactly among the rows whose hash came up again
    (equal hashes of different keys drop out there).  A bound of the repeated keys'
    number and bytes comes from the same hashes; only past it are they measured.  If
    the hashes themselves are too many to broadcast, all keys are counted.
    """
    spark = keyed.sparkSession
    ensure_checkpoint_dir(spark)
    width = reduce(lambda a, b: a + b, [F.octet_length(c) + F.lit(8) for c in key])
    again = (keyed.select(F.xxhash64(*key).alias(_HASH), width.alias("w"))
             .groupBy(_HASH).agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w"))
             .where(F.col("n") > 1).checkpoint())
    keys = F.expr("n div 2")  # of one hash: each repeated key takes two rows or more
    found = again.agg(F.count(F.lit(1)).alias("hashes"), F.sum(keys).alias("rows"),
                      F.sum(keys * (F.col("w") + F.lit(28))).alias("payload")).first()
    hashes, rows, payload = (int(x or 0) for x in found)
    if fits_broadcast(keyed, hashes, 8 * hashes):
        keyed = keyed.join(F.broadcast(again.select(_HASH)),
                           F.xxhash64(*key) == F.col(_HASH), "left_semi")
    repeated = _repeated(keyed, key)
    if fits_broadcast(keyed, rows, payload):
        return repeated, SizedSide(F.broadcast(repeated), rows, payload, True)
    return repeated, size_side(repeated)


def attach_key_count(df: DataFrame, key: tuple[str, ...], count_column: str,
                     measured: bool = True) -> DataFrame:
    """Add ``count_column``: how often the row's key occurs; NULL when a key part is NULL.

    Only keys seen more than once are carried to the join (usually a tiny set,
    map-side combined, so a key holding a third of all rows costs one partial
    count per task).  Every other non-NULL key counts 1.  Same values as a
    left join of the full ``groupBy(key).count()``, without shuffling the
    wide rows when the repeated-key set is small.  When it is too large to
    broadcast, its own counts name the hot keys of the split join
    (:func:`~navforge.operators.joins.split_join`).
    """
    keyed = df.where(all_not_null(key)).select(*key)
    if measured:
        repeated, side = _repeated_sized(keyed, key)
    else:
        repeated = _repeated(keyed, key)
        side = unsized(repeated)
    cols = df.columns
    joined = lookup_join(df, side, key, "left",
                         counts=repeated.withColumnRenamed(_DUP_N, "n"))
    count = F.when(all_not_null(key), F.coalesce(F.col(_DUP_N), F.lit(1)))
    return joined.select(*cols, count.cast("bigint").alias(count_column))


def prepare_reference(ref: DataFrame, dedupe: bool = True, measured: bool = True) -> SizedSide:
    """The valid ids (column ``id``) of a referenced dataset, ready to be looked up.

    ``dedupe=True`` keeps each id once, so a repeated id in the referenced
    table cannot multiply rows; ``dedupe=False`` keeps every copy and with it
    the fan-out of a plain join.  Measured once, the result serves every
    dataset that references it (the broadcast hint survives projections).
    """
    keys = ref.select("id").where(F.col("id").isNotNull())
    keys = keys.distinct() if dedupe else keys
    return size_side(keys) if measured else unsized(keys)


def attach_reference(df: DataFrame, column: str, keys: SizedSide, out: str,
                     narrow: DataFrame | None = None) -> DataFrame:
    """Left lookup of ``column`` in prepared ``keys``; ``out`` is NULL when unknown.

    Past the broadcast bound the lookup column's hot values are counted over
    ``narrow`` (a frame with the same rows but before earlier joins; default ``df``).
    """
    side = SizedSide(keys.frame.select(F.col("id").alias(column), F.col("id").alias(out)),
                     keys.rows, keys.payload_bytes, keys.broadcast, keys.checked)
    source = df if narrow is None else narrow
    counts = (source.select(column).where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n")))
    return lookup_join(df, side, [column], "left", counts).select(*df.columns, out)


def validate(bronze: DataFrame, spec: DatasetSpec, refs: dict[str, DataFrame] | None = None,
             dedupe_refs: bool = True, measured: bool = True,
             prepared: bool = False) -> DataFrame:
    """Standardised rows + key count + reference lookups + ``dq_issues`` array.

    ``refs`` maps a referenced dataset to its silver table, or, with
    ``prepared=True``, to its sized ids (see :func:`prepare_reference`).
    """
    df = narrow = standardize(bronze, spec)
    if spec.key:
        df = attach_key_count(df, spec.key, spec.count_column, measured)
    for ref in spec.references:
        if not refs or ref.dataset not in refs:
            raise ValueError(f"{spec.name}: reference dataset {ref.dataset!r} not given")
        keys = refs[ref.dataset] if prepared else \
            prepare_reference(refs[ref.dataset], dedupe_refs, measured)
        df = attach_reference(df, ref.column, keys, ref.out, narrow)
    return attach_issues(df, spec)


def attach_issues(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Add (or replace) ``dq_issues`` of rows that have their key count and lookups."""
    issues = issue_codes(spec.rules)
    if RAW_LINE in df.columns:  # a malformed line has this issue and no other
        issues = F.when(F.col(RAW_LINE).isNotNull(), F.array(F.lit(MALFORMED_LINE))).otherwise(
            issues)
    return df.withColumn(ISSUES, issues)


def _published(validated: DataFrame, spec: DatasetSpec) -> DataFrame:
    drop = set(spec.helper_columns) | {ISSUES, RAW_LINE}
    keep = [c for c in validated.columns if c not in drop]
    dates = [F.to_date(F.col(d.parsed)).alias(d.out) for d in spec.dates]
    return validated.select(*keep, *dates)


def valid_rows(validated: DataFrame, spec: DatasetSpec, run_ts: Column | None = None) -> DataFrame:
    """Silver table: rows without issues, helper columns dropped, dates as DATE."""
    out = _published(validated.where(F.size(ISSUES) == 0), spec)
    if run_ts is not None:
        out = out.withColumn("processed_at", run_ts)
    return out


def quarantine_rows(validated: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Quarantine table: rows with at least one issue, every column kept."""
    out = validated.where(F.size(ISSUES) > 0)
    if run_ts is not None:
        out = out.withColumn("quarantined_at", run_ts)
    return out
