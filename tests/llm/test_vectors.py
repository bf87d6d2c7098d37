from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from navforge.llm import embedding_dedup, topk
from navforge.llm.embedding_dedup import hash_shape, near_vectors
from navforge.llm.topk import exact_top_k, segment_features

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors():
    rng = np.random.default_rng(1)
    base = rng.standard_normal((160, 16)).astype(np.float32)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(base)]
    for i in range(160, 260):  # near copies, some below the threshold
        v = base[i % 12] + rng.standard_normal(16) * (0.05 + 0.25 * (i % 4 == 0))
        rows.append((i, [float(x) for x in v.astype(np.float32)], 1))
    rows += [(i, rows[3][1], 2) for i in range(260, 300)]  # exact copies
    rows += [(300, [float(2 * x) for x in rows[3][1]], 2)]
    rows += [(301, rows[5][1], 2), (301, rows[5][1], 2)]  # a repeated row
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [1.0, None] * 8, 0),
             (404, [float("nan")] * 16, 0), (405, [float("inf")] + [0.0] * 15, 0),
             (406, [1.0, 2.0], 0), (407, [2.0, 4.0], 0), (None, rows[3][1], 0),
             (500, [1e30] * 16, 0), (501, [-1e-30] * 16, 0), (502, [1e-30] * 16, 0)]
    return rows


def usable(v, zero=False):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and \
        (zero or any(v))


def brute_links(rows, threshold):
    keep = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows
            if i is not None and usable(v)]
    n = len(keep)
    link = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            x, y = keep[a][1], keep[b][1]
            if a != b and len(x) == len(y):
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                link[a, b] = x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold
    label = np.array([k[0] for k in keep])
    while True:
        low = np.array([min(label[a], label[link[a]].min(initial=label[a])) for a in range(n)])
        if (low == label).all():
            break
        label = low
    out = Counter((keep[a][0], int(link[a].sum()), int(label[a])) for a in range(n))
    out.update((i, 0, i) for i, v, _ in rows if i is None or not usable(v))
    return out


@pytest.mark.parametrize("tile", [512, 16])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_links", F.lit("clash"))
    got = near_vectors(df, threshold=0.95).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows, 0.95)
    for r in got:
        assert r.kept == (None if r.vec_id is None else r.vec_id == r.component_id)


def test_recall_against_brute_force(spark):
    """Pairs at the very threshold: the tables find all but about one in 10,000."""
    rng = np.random.default_rng(3)
    a = rng.standard_normal((600, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((600, 32))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9501 * a + np.sqrt(1 - 0.9501 ** 2) * b
    rows = [(2 * i, a[i].tolist(), 0) for i in range(600)] + \
        [(2 * i + 1, b[i].tolist(), 0) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = near_vectors(df).filter("vec_id % 2 = 1 and component_id = vec_id - 1").count()
    assert found >= 598
    bits, tables = hash_shape(10**9, 0.95)
    assert 1 - (1 - (1 - np.arccos(0.95) / np.pi) ** bits) ** tables >= 1 - 1.01e-4


def test_empty_vectors(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert near_vectors(df).collect() == []
    assert exact_top_k(df, F.col("id") % 2 == 0).collect() == []


@pytest.mark.parametrize("rows_in_block,queries_in_block", [(2048, 1024), (37, 5)])
def test_top_k(spark, monkeypatch, rows_in_block, queries_in_block):
    monkeypatch.setattr(topk, "ROWS", rows_in_block)
    monkeypatch.setattr(topk, "QUERIES", queries_in_block)
    rows = [r for r in vectors() if r[0] not in (500, 501, 502)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in exact_top_k(df, F.col("id") % 10 == 1, k=7).collect())
    keep = [(i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v])
            for i, v, _ in rows if i is not None and usable(v, zero=True)]
    want = Counter()
    for a, (q, x) in enumerate(keep):
        if q % 10 == 1:
            s = [(-sum(m * n for m, n in zip(x, y)), i) for b, (i, y) in enumerate(keep)
                 if b != a and len(y) == len(x)]
            want.update((q, r + 1, i, -v) for r, (v, i) in enumerate(sorted(s)[:7]))
    assert got == want


def test_top_k_beyond_doubles(spark):
    """Products above 2**53 are added as integers."""
    rows = [(0, [2.0 ** 40, 1.0]), (1, [2.0 ** 10, 3.0]), (2, [2.0 ** 10, 2.0]),
            (3, [2.0 ** 60, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in exact_top_k(df, F.col("id") == 0, scale=1.0).collect()]
    assert got == [(0, 1, 3, (1 << 63) - 1), (0, 2, 1, (1 << 50) + 3), (0, 3, 2, (1 << 50) + 2)]


def test_segment_bound():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((50, 24)), rng.standard_normal((9, 24))
    exact = q @ x.T
    slack = []
    for s in (1, 4, 12, 24):  # each resolution cuts the segments of the one before
        bound = segment_features(q, s) @ segment_features(x, s).T
        assert (bound >= exact - 1e-9).all()
        slack.append((bound - exact).mean())
    assert slack == sorted(slack, reverse=True)
    assert np.allclose(segment_features(q, 24) @ segment_features(x, 24).T, exact)
