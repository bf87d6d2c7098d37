"""Vectors of a table as packed bytes, and groups of packed vectors as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PACKED = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary()),
                     ("s1", pa.int64()), ("s2", pa.int64())])


def _pack(keep_zero: bool, scale: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(1)
            offsets = lists.offsets.to_numpy()
            flat = lists.values
            hole = flat.is_null().to_numpy(zero_copy_only=False)
            x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            bad = np.concatenate([[0], np.cumsum(hole | ~np.isfinite(x))])
            ok = (bad[offsets[1:]] == bad[offsets[:-1]]) & lists.is_valid().to_numpy(
                zero_copy_only=False)
            out = []
            for i in np.flatnonzero(ok):
                v = x[offsets[i]:offsets[i + 1]]
                if scale is not None:
                    v = np.floor(scale * v)
                elif not keep_zero and not v.any():
                    continue
                data = (v + 0.0).tobytes()  # -0.0 becomes 0.0
                d = np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), np.int64)
                out.append((ids[i], len(v), data, d[0], d[1]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _PACKED)], schema=_PACKED)
    return run


def packed(vectors: DataFrame, id_col: str, vec_col: str, *, keep_zero: bool = True,
           scale: float | None = None) -> DataFrame:
    """(id, dim, vec, s1, s2): the components as little-endian doubles and a 128-bit
    digest of them.  Vectors that are null or hold null or non-finite components
    (without ``keep_zero`` also zero vectors) are left out; ``scale`` gives
    floor(scale * x)."""
    values = F.col(vec_col).cast("array<double>")
    return (vectors.select(F.col(id_col).cast("long").alias("id"), values.alias("vec"))
            .mapInArrow(_pack(keep_zero, scale),
                        "id long, dim int, vec binary, s1 long, s2 long"))


def matrix(batch: pa.RecordBatch, column: str = "vec") -> np.ndarray:
    c = batch.column(batch.schema.get_field_index(column))
    data = np.frombuffer(b"".join(c.to_pylist()), np.float64)
    return data.reshape(len(c), len(data) // max(len(c), 1))
