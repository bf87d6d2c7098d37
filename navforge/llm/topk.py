"""Exact top-k inner products by multi-resolution segment statistics (operator 9).

Components become integers floor(scale * x).  For vectors cut into segments,
each kept as mean and deviation, the distance is at least

    |q - x|^2 >= sum over segments of w * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2),

and as |q - x|^2 = |q|^2 + |x|^2 - 2 q.x and each |.|^2 is the sum of
w * (mean^2 + dev^2), the bound on the distance is the bound
q.x <= sum of w * (mean_q * mean_x + dev_q * dev_x) on the score.  A block goes
from one segment to ever finer ones, dropping rows whose bound is below the
k-th best score found, and computes exact scores for the survivors.

Queries and rows meet in blocks of bounded size (every query block with every
row block); each block returns k rows a query, of which the best k remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, emit, longs
from navforge.llm.minhash_dedup import sorted_groups
from navforge.llm.vectors import matrix, packed

#: Rows and queries of a block.
ROWS = 2048
QUERIES = 1024
#: Segments at each resolution, coarse to fine (at most one for each component).
LEVELS = (1, 4, 16)
_MAX, _MIN = (1 << 63) - 1, -(1 << 63)
_FOUND = pa.schema([("qrow", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                    ("score", pa.int64())])


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(w) * (mean, deviation) of each segment; the product of two rows bounds
    the inner product of their vectors from above."""
    parts = [p for p in np.array_split(np.arange(x.shape[1]), max(segments, 1))
             if len(p)]
    cols = []
    for p in parts:
        w = np.sqrt(len(p))
        cols += [w * x[:, p].mean(axis=1), w * x[:, p].std(axis=1)]
    return np.stack(cols, axis=1) if cols else np.zeros((len(x), 1))


def _scores(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return x @ q
    out = [sum(int(a) * int(b) for a, b in zip(r, q)) for r in x]
    return np.array(out, dtype=object)


def _search(k: int, levels: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["dim", "cb", "qb"]):
            is_query = longs(g, "role") == 1
            if is_query.all() or not is_query.any():
                continue
            ids, row, vec = longs(g, "id"), longs(g, "row"), matrix(g)
            x, xid, xrow = vec[~is_query], ids[~is_query], row[~is_query]
            qs, qid, qrow = vec[is_query], ids[is_query], row[is_query]
            dim = x.shape[1]
            # Integers below 2**53 add up exactly in doubles; larger ones as Python integers.
            top = (np.abs(x).max(initial=0) or 1) * (np.abs(qs).max(initial=0) or 1) * max(dim, 1)
            exact = top < 2.0 ** 52
            slack = top * 1e-9
            fx = [segment_features(x, min(s, dim)) for s in levels if s <= max(dim, 1)]
            fq = [segment_features(qs, min(s, dim)) for s in levels if s <= max(dim, 1)]
            first = fq[-1] @ fx[-1].T if len(fx) else None
            out: list[tuple] = []
            for i in range(len(qs)):
                own = xrow == qrow[i]
                probe = np.argpartition(-first[i], min(2 * k, len(x) - 1))[:2 * k + 1]
                probe = probe[~own[probe]]
                sure = _scores(x[probe], qs[i], exact)
                limit = float(np.sort(sure.astype(np.float64))[-k]) if len(sure) >= k else -np.inf
                at = np.flatnonzero(~own)
                for a, b in zip(fx, fq):
                    at = at[a[at] @ b[i] + slack >= limit]
                s = _scores(x[at], qs[i], exact)
                order = sorted(range(len(at)), key=lambda j: (-s[j], xid[at[j]]))[:k] \
                    if not exact else np.lexsort((xid[at], -s))[:k]
                out += [(qrow[i], qid[i], xid[at[j]], min(max(int(s[j]), _MIN), _MAX))
                        for j in order]
            if out:
                yield from emit(_FOUND, *map(list, zip(*out)))
    return run


def exact_top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id",
                vec_col: str = "embedding", k: int = 10, scale: float = 1024.0,
                levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each query row.

    ``is_query`` is a condition on column ``id``.  A query's candidates are all
    other rows of its dimension, copies under its id included; ties go to the
    smaller id.  Rows with a null id, a null vector or null or non-finite
    components take no part; a score outside 64 bits counts as the nearest long.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    rows = scratch.write(
        packed(vectors.filter(F.col(id_col).isNotNull()), id_col, vec_col, scale=scale)
        .select(F.monotonically_increasing_id().alias("row"), "id", "dim", "vec"), "rows")
    n, n_query = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    row_blocks, query_blocks = max(1, -(-n // ROWS)), max(1, -(-n_query // QUERIES))

    def blocks(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(count).cast("long"))

    cols = ["dim", "cb", "qb", "role", "id", "row", "vec"]
    cand = rows.withColumns({"role": F.lit(0), "cb": block(row_blocks)}).withColumn(
        "qb", blocks(query_blocks))
    query = rows.filter(is_query).withColumns({"role": F.lit(1), "qb": block(query_blocks)}) \
        .withColumn("cb", blocks(row_blocks))
    found = (cand.select(cols).unionByName(query.select(cols))
             .repartition("dim", "cb", "qb").sortWithinPartitions("dim", "cb", "qb")
             .mapInArrow(_search(k, levels), "qrow long, query_id long, vec_id long, score long"))
    order = W.partitionBy("qrow").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
