"""Near-duplicate embeddings by random-hyperplane hashing (operator 5).

Equal vectors collapse to one node with a multiplicity.  Each of several hash
tables keys a node by the signs of its products with random hyperplanes; the
bits grow with the number of nodes, so that buckets of unrelated vectors keep
their size, and the tables are as many as bring the chance to miss a pair at
the threshold below ``MISS``.  Buckets are cut into tiles, and every pair of
tiles is one group of bounded size in which exact cosines are computed in
double precision.  A pair counts in the first table that brings it together
only; what leaves a group are link counts and the edges of a spanning forest,
not the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, emit, longs
from navforge.llm.components import connected_components
from navforge.llm.minhash_dedup import sorted_groups
from navforge.llm.vectors import matrix, packed

MISS = 1e-4
TILE = 512
_CODES = pa.schema([("node", pa.int64()), ("dim", pa.int32()), ("copies", pa.int64()),
                    ("vec", pa.binary()), ("codes", pa.binary())])
_PART = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def hash_shape(nodes: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) for so many vectors."""
    bits = min(31, max(6, math.ceil(math.log2(max(nodes, 2) / 16))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-same)))


def _codes(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            dims = longs(batch, "dim")
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng(7 * int(dim) + 1).standard_normal(
                        (int(dim), bits * tables))
                for i in range(0, part.num_rows, 2048):
                    piece = part.slice(i, 2048)
                    sign = (matrix(piece) @ planes[dim] > 0).reshape(piece.num_rows, tables, bits)
                    code = (sign * weight).sum(axis=2).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*(piece.column(piece.schema.get_field_index(c))
                           for c in ("node", "dim", "copies", "vec")),
                         pa.array([r.tobytes() for r in code], pa.binary())], schema=_CODES)
    return run


def _keys(tables: int):
    """One row per table: (table, code) of each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("dim", pa.int32()), ("t", pa.int32()),
                            ("code", pa.int32())])
        for batch in batches:
            c = batch.column(batch.schema.get_field_index("codes")).to_pylist()
            code = np.frombuffer(b"".join(c), np.int32)
            yield from emit(schema, np.repeat(longs(batch, "node"), tables),
                            np.repeat(longs(batch, "dim"), tables),
                            np.tile(np.arange(tables, dtype=np.int32), len(c)), code)
    return run


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["dim", "t", "code", "i", "j"]):
            if g.num_rows < 2:
                continue
            v, node, copies = matrix(g), longs(g, "node"), longs(g, "copies")
            tile = longs(g, "tile")
            i, j = longs(g, "i")[0], longs(g, "j")[0]
            # Scaled first, so that squares neither overflow nor vanish.
            v = v / np.abs(v).max(axis=1, keepdims=True)
            v = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
            a, b = (np.flatnonzero(tile == i), np.flatnonzero(tile == j))
            link = v[a] @ v[b].T >= threshold
            if i == j:
                np.fill_diagonal(link, False)
            x, y = np.nonzero(link)
            if not len(x):
                continue
            codes = np.frombuffer(b"".join(g.column(g.schema.get_field_index("codes"))
                                           .to_pylist()), np.int32).reshape(g.num_rows, -1)
            t = int(longs(g, "t")[0])
            first = np.ones(len(x), bool)
            for k in range(t):
                first &= codes[a[x], k] != codes[b[y], k]
            total = np.zeros(g.num_rows, np.int64)
            np.add.at(total, a[x[first]], copies[b[y[first]]])
            if i != j:
                np.add.at(total, b[y[first]], copies[a[x[first]]])
            label = np.arange(g.num_rows)
            while True:
                low = label.copy()
                np.minimum.at(low, a[x], label[b[y]])
                np.minimum.at(low, b[y], label[a[x]])
                low = low[low]
                if (low == label).all():
                    break
                label = low
            counted = np.flatnonzero(total)
            if len(counted):
                yield from emit(_PART, node[counted], total[counted],
                                pa.nulls(len(counted), pa.int64()))
            moved = np.flatnonzero(label != np.arange(len(label)))
            yield from emit(_PART, node[moved], np.zeros(len(moved), np.int64),
                            node[label[moved]])
    return run


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
                 threshold: float = 0.95) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, zero, empty or hold null or non-finite components
    link with nothing.  Only vectors of equal dimension are compared.  Rows that
    share an id are vectors of their own; rows with a null id take no part in
    links (component_id and kept null).
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    all_rows = scratch.write(
        packed(vectors.filter(F.col(id_col).isNotNull()), id_col, vec_col, keep_zero=False)
        .filter("dim > 0").withColumn("row", F.monotonically_increasing_id()), "rows")
    classes = scratch.write(all_rows.groupBy("s1", "s2", "dim").agg(
        F.min("row").alias("node"), F.min("id").alias("low"),
        F.count(F.lit(1)).alias("copies")), "classes")
    nodes = all_rows.select("row", "vec").join(
        classes, all_rows["row"] == classes["node"]).select("node", "dim", "copies", "vec")
    bits, tables = hash_shape(classes.count(), threshold)
    coded = scratch.write(
        nodes.mapInArrow(_codes(bits, tables),
                         "node long, dim int, copies long, vec binary, codes binary"), "coded")
    keys = coded.mapInArrow(_keys(tables), "node long, dim int, t int, code int")
    buckets = scratch.write(keys.groupBy("dim", "t", "code").count().filter("count > 1")
                            .select("dim", "t", "code", F.ceil(F.col("count") / TILE)
                                    .cast("int").alias("tiles")), "buckets")
    placed = (keys.join(buckets, ["dim", "t", "code"])
              .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
              .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .select("node", "t", "code", "tile", F.least("tile", "o").alias("i"),
                      F.greatest("tile", "o").alias("j")))
    parts = scratch.write(
        placed.join(coded, "node")
        .select("dim", "t", "code", "i", "j", "tile", "node", "copies", "vec", "codes")
        .repartition("dim", "t", "code", "i", "j")
        .sortWithinPartitions("dim", "t", "code", "i", "j")
        .mapInArrow(_verify(threshold), "node long, links long, other long"), "parts")
    edges = parts.filter("other is not null").select(F.col("node").alias("a"),
                                                     F.col("other").alias("b")).distinct()
    labels = connected_components(edges, scratch)
    links = parts.groupBy("node").agg(F.sum("links").alias("links"))
    joined = (classes.join(links, "node", "left").join(labels, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    lowest = joined.groupBy("component").agg(F.min("low").alias("component_id"))
    described = scratch.write(joined.join(lowest, "component").select(
        "s1", "s2", "dim", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "described")
    scratch.drop("classes", "coded", "buckets", "parts", "cc-labels")
    linked = all_rows.select("id", "s1", "s2", "dim").join(described, ["s1", "s2", "dim"]).select(
        F.col("id").alias("vec_id"), "n_links", "component_id")
    # The rows that take no part: null ids, and those that packed() leaves out.
    x = F.col(vec_col).cast("array<double>")
    usable = F.coalesce(
        (F.size(x) > 0)
        & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
        & F.exists(x, lambda c: c != 0.0), F.lit(False)) & F.col(id_col).isNotNull()
    alone = vectors.filter(~usable).select(
        F.col(id_col).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.col(id_col).cast("long").alias("component_id"))
    return linked.unionByName(alone).select(
        "vec_id", "n_links", "component_id",
        (F.col("vec_id") == F.col("component_id")).alias("kept"))
