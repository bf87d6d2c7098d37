from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from navforge.llm.substring_dedup import _LAST, substring_dedup


def brute(rows, window):
    """The rule itself: a window goes that also starts at a smaller (id, start)."""
    first: dict[tuple, tuple] = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for s in range(len(words) - window + 1):
            key, place = tuple(words[s:s + window]), (_LAST if i is None else i, s)
            first[key] = min(first.get(key, place), place)
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        keep = [True] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < (_LAST if i is None else i, s):
                keep[s:s + window] = [False] * window
        out.append((i, words, keep))
    return out


@pytest.mark.parametrize("window,period,cover", [(20, 13, (0, 1, 3, 9)), (6, 3, (0, 1))])
def test_equals_brute_force(docs, rows, window, period, cover):
    got = substring_dedup(docs, window=window, period=period, cover=cover, digest=True).collect()
    want = Counter((i, len(w), keep.count(False), hashlib.sha256(
        b" ".join(x for x, k in zip(w, keep) if k)).hexdigest())
        for i, w, keep in brute(rows, window))
    assert Counter(tuple(r) for r in got) == want
    assert sum(r.n_removed for r in got) > 500


def test_many_partitions_cut_runs(spark, docs, rows):
    """Runs of one window split over range partitions leave exactly one first place."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = substring_dedup(docs, digest=True).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = Counter((i, len(w), keep.count(False)) for i, w, keep in brute(rows, 20))
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in got) == want


def test_general_output_keeps_columns(docs, rows):
    clash = docs.withColumn("n_words", F.lit("x")).withColumn("row", F.lit(1))
    got = substring_dedup(clash).collect()
    want = Counter((i, t, b" ".join(x for x, k in zip(w, keep) if k).decode())
                   for (i, t), (_, w, keep) in zip(rows, brute(rows, 20)))
    assert Counter((r.doc_id, r.text, r.kept_text) for r in got) == want


def test_one_id_with_two_texts(spark):
    words = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, words), (1, "lead " + words), (2, words)],
                               "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed)
                 for r in substring_dedup(df, digest=True).collect())
    # The same id: only by start; the window that starts later goes.
    assert got == [(1, 30, 0), (1, 31, 30), (2, 30, 30)]


def test_empty_table(no_docs):
    assert substring_dedup(no_docs, digest=True).collect() == []


def test_bad_cover(docs):
    with pytest.raises(ValueError):
        substring_dedup(docs, period=13, cover=(0, 1))


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_of_thue_morse_letters_differ(spark, size):
    """Sequences on which hashes that are polynomials modulo a power of two collide."""
    x, y = "a", "b"
    while len(x) < size:
        x, y = x + y, y + x
    rows = [(1, " ".join([x, "c", "d"] * 8)), (2, " ".join([y, "c", "d"] * 8)),
            (3, " ".join([y, "c", "d"] * 9)), (4, " ".join(x)), (5, " ".join(y))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup(df, digest=True).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == Counter(
        (i, keep.count(False)) for i, _, keep in brute(rows, 20))
