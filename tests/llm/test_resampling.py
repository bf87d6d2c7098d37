from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from navforge.llm.resampling import bisect, importance_resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + n]) for n in range(1, longest + 1)
                    for i in range(len(w) - n + 1)]


def brute(rows, target, per_cent=10, least=20, longest=1, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in rows for f in runs(t, longest)[1])
    t = Counter(bucket(f) for x in target for f in runs(x, longest)[1])
    up, down = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for i, text in rows:
        n, own = runs(text, longest)
        weight = sum(math.floor(1000 * math.log(
            (t[bucket(f)] + 1) * up / ((s[bucket(f)] + 1) * down))) for f in own)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        out.append((i, len(own), weight, score, n))
    pool = sorted((-r[3], r[0], r[1]) for r in out if r[0] is not None and r[4] >= least)
    pool = Counter(pool[:per_cent * len(pool) // 100])
    rank, place = {}, 0
    for key, n in sorted(pool.items()):
        rank[key] = list(range(place + 1, place + n + 1))
        place += n
    result = []
    for i, n, weight, score, words in out:
        key = None if i is None or words < least else (-score, i, n)
        result.append((i, n, weight, score, rank[key].pop() if rank.get(key) else None))
    return sorted(result, key=repr)


def drawn(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()),
                  key=repr)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "abc de fgab cde 42 Über"), (2, None), (3, "")],
                                 "item_id long, text string")


TARGET = ["abc de fgab cde 42 Über"]


@pytest.mark.parametrize("per_cent,least,longest", [(10, 20, 1), (50, 1, 2), (100, 0, 1), (0, 5, 1)])
def test_equals_brute_force(spark, docs, rows, target, per_cent, least, longest):
    got = importance_resample(docs, target, per_cent=per_cent, least_words=least, longest=longest)
    assert drawn(got) == brute(rows, TARGET, per_cent, least, longest)


def test_ties_and_repeated_rows(spark, target):
    """Rows alike in every column are drawn as often as the limit allows."""
    text = "abc de fgab " * 10
    rows = [(7, text)] * 6 + [(8, text)] * 6 + [(9, "other words " * 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for per_cent in range(0, 101, 7):
        assert drawn(importance_resample(df, target, per_cent=per_cent)) == brute(
            rows, TARGET, per_cent)


def test_bisection_finds_every_order_statistic(spark):
    rng = random.Random(3)
    values = [rng.choice([-2 ** 62, -5, 0, 1, 1, 1, 17, 10 ** 15, 2 ** 62]) for _ in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for need in (1, 7, 20, 39, 40):
        x = sorted(values)[need - 1]
        assert bisect(df, F.col("v"), need) == (x, sum(v < x for v in values), values.count(x))


def test_many_range_partitions_give_gapless_ranks(spark, target):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(25))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    got = importance_resample(df, target, per_cent=60)
    assert drawn(got) == brute(rows, TARGET, 60)


def test_empty_tables_and_clashing_columns(spark, docs, no_docs, rows, target):
    assert importance_resample(no_docs, target).collect() == []
    nothing = target.filter("item_id > 9")
    assert drawn(importance_resample(docs, nothing)) == brute(rows, [])
    clash = docs.withColumns({c: F.lit("x") for c in ("score", "rank", "weight", "bucket", "n", "h")})
    assert drawn(importance_resample(clash, target.withColumn("bucket", F.lit(1)))) == brute(
        rows, TARGET)
