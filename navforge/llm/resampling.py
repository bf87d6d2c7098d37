"""Importance resampling towards a target distribution (operator 12).

1. Hashed word features of all documents and of all target texts are counted per
   bucket; the counts give one integer gain a bucket.
2. A document's weight is the sum of the gains of its features, looked up in the
   array of gains; the score adds Gumbel noise that its id determines.  Scores are
   written once.
3. The cutoff of the draw is found by bisection: exact counts of the written scores
   at thresholds.  A job counts at the 31 thresholds that five halvings could ask
   for.  Among documents tied at the cutoff the smallest ids are taken, the last of
   them again by bisection.
4. The drawn rows are range-partitioned by score and id; a row's rank is its place
   in its partition plus the sizes of the partitions before it.

Only the bucket counts, the thresholds' counts and the partitions' sizes reach the
driver; none grows with the tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, text_slices

BUCKETS = 10_000
SEED = 2024
#: Parts into which one bisection job divides the range.
PARTS = 32

# A-Z to lower case; what no word holds to a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else
               c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WEIGHTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                      ("n_features", pa.int64()), ("weight", pa.int64())])


def words(text: bytes) -> list[bytes]:
    """Runs of digits, letters a-z (A-Z lower-cased) and bytes above 0x7F."""
    return text.translate(_TABLE).split()


def features(found: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """Buckets of all runs of 1 to ``longest`` words."""
    runs = [np.fromiter(map(zlib.crc32, found), np.uint32, len(found))]
    for n in range(2, longest + 1):
        joined = [b" ".join(found[i:i + n]) for i in range(len(found) - n + 1)]
        runs.append(np.fromiter(map(zlib.crc32, joined), np.uint32, len(joined)))
    return np.concatenate(runs) % np.uint32(buckets)


def _count(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                for t in texts:
                    total += np.bincount(features(words(t), longest, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])],
                                         names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features of a table's column ``text`` in each bucket."""
    parts = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(
        _count(longest, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets``
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the smoothed ratio of frequencies) of each bucket."""
    n = len(source)
    up = (target + 1).astype(np.float64) * float(source.sum() + n)
    down = (source + 1).astype(np.float64) * float(target.sum() + n)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def _weigh(longest: int, gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                n = np.zeros((3, len(texts)), np.int64)
                for i, t in enumerate(texts):
                    found = words(t)
                    own = features(found, longest, len(gain))
                    n[:, i] = len(found), len(own), gain[own].sum()
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, n)],
                                                 schema=_WEIGHTS)
    return run


def bisect(df: DataFrame, value: Column, need: int) -> tuple[int, int, int]:
    """(smallest x with at least ``need`` values <= x, number of values < x, = x)."""
    df = df.select(value.cast("long").alias("x"))
    low, high = df.agg(F.min("x"), F.max("x")).first()
    while low < high:  # the answer lies in [low, high]
        step = -(-(high - low) // PARTS)
        cuts = [c for c in range(low + step - 1, high, step) if c < high] or [low]
        counts = df.agg(*[F.count_if(F.col("x") <= F.lit(c)) for c in cuts]).first()
        reached = [c for c, n in zip(cuts, counts) if n >= need]
        missed = [c for c, n in zip(cuts, counts) if n < need]
        low, high = (missed[-1] + 1 if missed else low), (reached[0] if reached else high)
    less, same = df.agg(F.count_if(F.col("x") < F.lit(low)),
                        F.count_if(F.col("x") == F.lit(low))).first()
    return low, less, same


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, place, np.int32)),
             pa.array(np.arange(at + 1, at + n + 1))], names=[*batch.schema.names, "place", "nth"])
        at += n


def ranked(drawn: DataFrame, scratch: Scratch, order: list[Column]) -> DataFrame:
    """``drawn`` with ``rank`` 1, 2, 3... in the given order."""
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in drawn.schema)
    numbered = scratch.write(
        drawn.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_numbered, f"{layout}, place int, nth long"), "ranked")
    sizes = sorted((r["place"], r["count"]) for r in numbered.groupBy("place").count().collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    offsets = drawn.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, before)], "place int, before long")
    return numbered.join(F.broadcast(offsets), "place").select(  # one row a partition
        *drawn.columns, (F.col("nth") + F.col("before")).alias("rank"))


def importance_resample(docs: DataFrame, target: DataFrame, *, per_cent: int = 10,
                        least_words: int = 20, longest: int = 1, buckets: int = BUCKETS,
                        seed: int = SEED) -> DataFrame:
    """Every document with doc_id, n_features, weight, score and, if drawn, its rank.

    Of the N documents with an id and ``least_words`` words, floor(per_cent * N / 100)
    with the highest scores are drawn, ties to the smaller id, then to fewer features;
    rows equal in all three are alike in every column returned.  Null and empty texts
    have no features and weight 0; a row with a null id has a null score and is never
    drawn.  Texts of any length are read whole.  Repeated rows count apart.  Other
    columns are not looked at.  An empty target gives every bucket its smoothed gain.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text"))
    gain = gains(bucket_counts(base, longest, buckets), bucket_counts(target, longest, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = scratch.write(
        base.mapInArrow(_weigh(longest, gain),
                        "doc_id long, n_words long, n_features long, weight long")
        .select("doc_id", "n_words", "n_features", "weight",
                (F.col("weight") + noise).cast("long").alias("score")), "scored")
    eligible = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    pool = scored.filter(eligible)
    need = per_cent * pool.count() // 100
    out = scored.select("doc_id", "n_features", "weight", "score")
    if not need:
        return out.withColumn("rank", F.lit(None).cast("long"))

    inside, tied, total = F.lit(False), eligible, need
    for key in (-F.col("score"), F.col("doc_id"), F.col("n_features")):
        x, less, same = bisect(scored.filter(tied), key, need)
        inside |= tied & (key < F.lit(x))
        tied &= key == F.lit(x)
        need -= less
        if need == same:
            break
    if need == same:
        inside |= tied
        parts = [out.filter(~F.coalesce(inside, F.lit(False)))]
        drawn = out.filter(inside)
    else:  # rows alike in every column: as many as are needed, the others are left
        one = out.filter(tied).limit(1)
        parts = [out.filter(~F.coalesce(inside | tied, F.lit(False))),
                 one.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(same - need)))).drop("_")]
        drawn = out.filter(inside).unionByName(
            one.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(need)))).drop("_"))
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features").asc()]
    result = ranked(drawn, scratch, order)
    for p in parts:
        result = result.unionByName(p.withColumn("rank", F.lit(None).cast("long")))
    return result
