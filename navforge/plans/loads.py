"""Validation load by load, with the result of validating all loads at once.

A row's verdict may depend on other rows: how often its key occurs, and whether the ids
that it refers to are valid.  So a load can change what earlier loads were told:

* a later copy of a key takes the earlier, so far valid copy to the quarantine, and
  raises the count shown there;
* a fund or investor that arrives late makes rows valid that were quarantined as
  referring to an unknown id, and an investor whose id is repeated later makes valid
  rows refer to an unknown one.

``apply_load`` validates the new rows and re-checks, of the earlier ones, those that hold
a repeated key or an id that occurs in this load's rows of a referenced table: no other
verdict can change.  Tables, beside the published ones of silver and quarantine:

    state/<dataset>        every row with its key count, lookups and issues, one part a
                           load (what a full run stages for its two writes, kept)
    state/<dataset>_keys   the key index

All three tables of a dataset have one part a load.  A part with no row to re-check is
not read beyond its key and id columns, and only then if keys or ids came that may be in
it.  A load that is repeated, also one that broke off anywhere, gives the same tables:
everything is computed from absolute counts, and ``state``, by which rows to re-check are
found, is published last.  A load has a number above those before it and one writer.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navforge.operators import ops
from navforge.operators.joins import SizedSide, all_not_null, lookup_join, size_side
from navforge.operators.quality import (
    attach_issues, attach_reference, prepare_reference, quarantine_rows, standardize, valid_rows,
)
from navforge.sources.keyindex import EARLIER, TOTAL, KeyIndex
from navforge.sources.sinks import Lakehouse
from navforge.sources.staging import release_staged, staged
from navforge.specs import DATASETS, DatasetSpec

LOAD = "__load"
_STATE = "state"


@dataclass
class Changes:
    """What a load did to a dataset: earlier loads with re-checked rows, and the days of
    new, re-checked and re-described rows (for ``pipeline.refresh_gold``)."""

    loads: list[int] = field(default_factory=list)
    days: list[dt.date] = field(default_factory=list)


def _part(load: int) -> str:
    return f"load-{load}"


def _arrived(spark: SparkSession, lake: Lakehouse, dataset: str, load: int,
             valid: DataFrame) -> SizedSide | None:
    """Ids in a load's rows of a referenced dataset, and which of them are valid now."""
    version = lake.version(spark, _STATE, dataset)
    if version is None or _part(load) not in version.parts:
        return None
    ids = (lake.read_part(spark, _STATE, dataset, _part(load)).select("id")
           .where(F.col("id").isNotNull()).distinct())
    rows = ids.join(valid.select("id", F.lit(True).alias("__ok")), "id", "left")
    side = size_side(staged(rows.select("id", F.coalesce("__ok", F.lit(False)).alias("__ok")),
                            "arrived"))
    return side if side.rows else None


class _Recheck:
    """Joins that give earlier rows their key count and lookups as they are now."""

    def __init__(self, spec: DatasetSpec, repeated: SizedSide | None,
                 arrived: dict[str, SizedSide]) -> None:
        self.spec, self.repeated = spec, repeated
        self.references = [r for r in spec.references if r.dataset in arrived]
        self.arrived = arrived

    def __bool__(self) -> bool:
        return bool(self.repeated or self.references)

    def __call__(self, rows: DataFrame) -> tuple[DataFrame, Column, Column]:
        """(rows with the new values, whether one differs, whether the row was met)."""
        spec, df, new = self.spec, rows, {}
        differs, met = F.lit(False), F.lit(False)
        if self.repeated:
            df = lookup_join(df, self.repeated, spec.key, "left")
            new[spec.count_column] = F.coalesce(F.col(TOTAL), F.col(spec.count_column))
            met = met | F.col(TOTAL).isNotNull()
        for i, ref in enumerate(self.references):
            side = self.arrived[ref.dataset]
            ok = f"__ok{i}"
            df = lookup_join(df, SizedSide(
                side.frame.select(F.col("id").alias(ref.column), F.col("__ok").alias(ok)),
                side.rows, side.payload_bytes, side.broadcast), [ref.column], "left")
            new[ref.out] = F.when(F.col(ok), F.col(ref.column)).when(
                F.col(ok).isNull(), F.col(ref.out))
            met = met | F.col(ok).isNotNull()
        for column, value in new.items():
            differs = differs | ~value.eqNullSafe(F.col(column))
        df = df.withColumns({"__differs": differs, "__met": met, **{
            f"__new_{c}": v for c, v in new.items()}})
        values = [F.col(f"__new_{c}").alias(c) if c in new else F.col(c) for c in rows.columns]
        return df.select(*values, "__differs", "__met"), F.col("__differs"), F.col("__met")


def _apply(spark: SparkSession, lake: Lakehouse, spec: DatasetSpec, load: int,
           bronze: DataFrame | None, valid: dict[str, SizedSide],
           arrived: dict[str, SizedSide], run_ts: Column, buckets: int) -> Changes:
    name, repeated = spec.name, None
    parts: dict[str, DataFrame] = {}
    out = Changes()
    day = spec.dates[0].parsed if spec.references else None
    index = KeyIndex(f"{lake.root.rstrip('/')}/{_STATE}/{name}_keys", spec.key, buckets)
    if bronze is not None:
        rows = standardize(bronze, spec)
        if spec.key:
            index.add(rows.select(*spec.key), load)
            repeated = staged(index.repeated(spark, load), "repeated")
            totals = size_side(repeated.drop(EARLIER))
            columns = rows.columns
            count = F.when(all_not_null(spec.key), F.coalesce(F.col(TOTAL), F.lit(1)))
            rows = lookup_join(rows, totals, spec.key, "left").select(
                *columns, count.cast("bigint").alias(spec.count_column))
        for ref in spec.references:
            rows = attach_reference(rows, ref.column, valid[ref.dataset], ref.out)
        parts[_part(load)] = attach_issues(rows, spec).withColumn(
            LOAD, F.lit(load).cast("int"))
    # Earlier rows whose verdict may have changed.
    version = lake.version(spark, _STATE, name)
    if version and set(version.parts) - {_part(load)}:
        again = size_side(repeated.where(EARLIER).drop(EARLIER)) if repeated is not None else None
        recheck = _Recheck(spec, again if again and again.rows else None, arrived)
        if recheck:
            narrow = [*spec.key, *([spec.count_column] if spec.key else []),
                      *[c for r in spec.references for c in (r.column, r.out)],
                      *([day] if day else []), LOAD]
            state = lake.read(spark, _STATE, name).where(F.col(LOAD) != load)
            found, differs, met = recheck(state.select(*dict.fromkeys(narrow)))
            seen = (found.where(met).groupBy(LOAD, F.to_date(F.col(day) if day else F.lit(None))
                                             .alias("day"))
                    .agg(F.max(differs).alias("differs")).collect())  # loads x days at most
            out.loads = sorted({r[LOAD] for r in seen if r["differs"]})
            out.days = sorted({r["day"] for r in seen if r["day"]})
            for earlier in out.loads:
                old = lake.read_part(spark, _STATE, name, _part(earlier))
                parts[_part(earlier)] = attach_issues(
                    recheck(old)[0].select(*old.columns), spec)
    if not parts:
        return out
    saved = lake.save_parts(parts, _STATE, name)
    now = {p: lake.read_part(spark, _STATE, name, p, saved[0]) for p in parts}
    lake.write_parts({p: valid_rows(df.drop(LOAD), spec, run_ts) for p, df in now.items()},
                     "silver", name)
    lake.write_parts({p: quarantine_rows(df.drop(LOAD), run_ts) for p, df in now.items()},
                     "ops", f"dq_{name}_quarantine")
    lake.publish_parts(spark, _STATE, name, saved)
    if bronze is not None and day:
        fresh = lake.read_part(spark, _STATE, name, _part(load))
        out.days = sorted({*out.days, *(r[0] for r in fresh.select(F.to_date(day)).distinct()
                                        .collect() if r[0])})  # as many rows as days
    return out


def apply_load(spark: SparkSession, lake: Lakehouse, load: int, bronze: dict[str, DataFrame],
               run_ts: Column, buckets: int = 64) -> dict[str, Changes]:
    """Validate the raw rows of one load (of any of the datasets) and bring silver,
    quarantine and the quality metrics up to date.  After any number of loads the tables
    equal those of one run over all rows (references de-duplicated; audit times are those
    of the load that last wrote a part).  Returns the changes by dataset."""
    out, valid, arrived = {}, {}, {}
    referenced = {r.dataset for spec in DATASETS.values() for r in spec.references}
    for name, spec in DATASETS.items():
        if name in bronze or lake.exists(spark, _STATE, name):
            out[name] = _apply(spark, lake, spec, load, bronze.get(name), valid, arrived,
                               run_ts, buckets)
        if name in referenced:
            silver = lake.read(spark, "silver", name) if lake.exists(spark, "silver", name) \
                else spark.createDataFrame([], "id string")
            valid[name] = prepare_reference(silver)
            side = _arrived(spark, lake, name, load, valid[name].frame)
            if side:
                arrived[name] = side
    metrics = [ops.dq_metrics_written(n, lake.read(spark, _STATE, n),
                                      lake.read(spark, "silver", n),
                                      lake.read(spark, "ops", f"dq_{n}_quarantine"), run_ts)
               for n in out if lake.exists(spark, _STATE, n)]
    if metrics:
        lake.write(reduce(DataFrame.unionByName, metrics), "ops", "dq_metrics", "append",
                   batch=("loads", load))
    release_staged()
    return out
