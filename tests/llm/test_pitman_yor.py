from __future__ import annotations

import math
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from navforge.llm import pitman_yor as py
from tests.conftest import SF_SMALL

SMALL = {"block_tokens": 300, "block_bytes": 400, "shard": 150, "split": 20}


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def held():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]  # None: the end


def brute(rows, theta=1.0):
    """Scores with one table a pair, and the add-one scores."""
    pairs, c = Counter(), Counter()
    for i, t in rows:
        if not is_held(i):
            w = tokens(t)
            c.update(w)
            pairs.update(zip([None, *w], w))
    n, v = c.total(), len(c)

    def d(counts):
        return py.discount(sum(x == 1 for x in counts), sum(x == 2 for x in counts))

    size, types, parent = Counter(), Counter(), Counter()
    for (u, w), k in pairs.items():
        size[u] += k
        types[u] += 1
        parent[w] += 1
    d1, d0, all_types = d(pairs.values()), d(parent.values()), parent.total()

    def q(w):
        return (max(parent[w] - d0, 0) + (theta + d0 * v) / (v + 1)) / (theta + all_types)

    def p(u, w):
        return ((max(pairs[u, w] - d1, 0) + (theta + d1 * types[u]) * q(w)) / (theta + size[u]))

    out = []
    for i, t in rows:
        w = tokens(t)
        out.append((i, is_held(i), len(w), sum(c[x] > 0 for x in w), n,
                    sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w),
                    sum(math.log10(p(u, x)) for u, x in zip([None, *w], w))))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(got, want, base_only=False):
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9), g[0]
        if not base_only:
            assert g[6] == pytest.approx(w[6], rel=1e-5, abs=1e-5), g[0]


@pytest.mark.parametrize("sizes", [{}, SMALL], ids=["one block", "many blocks and buckets"])
def test_one_table_a_pair_equals_brute_force(docs, rows, sizes):
    same(collected(py.score_documents(docs, held(), sweeps=0, **sizes)), brute(rows))


def test_sweeps_keep_counts_and_agree_however_the_work_is_dealt_out(docs, rows):
    want = brute(rows)
    whole = collected(py.score_documents(docs, held(), sweeps=3))
    dealt = collected(py.score_documents(docs, held(), sweeps=3, **SMALL))
    same(whole, want, base_only=True)
    same(dealt, want, base_only=True)
    a, b = (np.array([r[6] for r in x]) for x in (whole, dealt))
    assert abs(a.sum() / b.sum() - 1) < 0.01
    assert np.all(a <= 0) and np.all(b <= 0)


def test_model_beats_single_words_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = py.score_documents(docs, held()).filter("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def exact(c, others, q, theta, d):
    """Distribution of the tables of c customers, by the recursion over customers."""
    s = np.full(c + 1, -np.inf)
    s[1] = 0
    t = np.arange(c + 1)
    for n in range(1, c):
        with np.errstate(divide="ignore"):
            s = np.logaddexp(np.concatenate([[-np.inf], s[:-1]]), np.log(np.maximum(n - d * t, 0)) + s)
    s[1:] += np.concatenate([[0], np.cumsum(np.log((theta + d * (others + t[1:-1])) * q))])
    p = np.exp(s - s.max())
    return p / p.sum()


@pytest.mark.parametrize("c,others,q,theta,d", [
    (2, 0, 0.3, 1.0, 0.5), (3, 10, 0.05, 1.0, 0.7), (9, 3, 0.4, 2.0, 0.3), (40, 25, 0.1, 1.0, 0.8),
    (1, 5, 0.5, 1.0, 0.5), (100, 1000, 0.01, 1.0, 0.9)])
def test_seats_follow_the_exact_distribution(c, others, q, theta, d):
    n = 40_000
    t = py.seat(np.full(n, c), np.full(n, others), np.full(n, q), theta, d,
                np.random.default_rng(1))
    got, want = np.bincount(t, minlength=c + 1) / n, exact(c, others, q, theta, d)
    assert np.abs(got - want).max() < 0.015


@pytest.mark.parametrize("c,others,q,theta,d", [
    (101, 0, 0.3, 1.0, 0.5), (300, 100, 0.02, 1.0, 0.8), (1000, 5000, 0.01, 1.0, 0.7),
    (2000, 10, 1e-4, 1.0, 0.9), (1500, 300, 0.3, 1.0, 0.6)])
def test_seats_of_more_customers_come_near_the_exact_distribution(c, others, q, theta, d):
    n = 10_000
    t = py.seat(np.full(n, c), np.full(n, others), np.full(n, q), theta, d,
                np.random.default_rng(1))
    want = exact(c, others, q, theta, d)
    mean = (want * np.arange(c + 1)).sum()
    deviation = (want * (np.arange(c + 1) - mean) ** 2).sum() ** 0.5
    assert abs(t.mean() - mean) < 0.25 * deviation + 0.02
    assert 0.8 * deviation - 0.02 < t.std() < 1.25 * deviation + 0.02
    # By importance weights alone nearly nothing is left of the difference.
    few, weight = py._one_by_one(np.full(n, float(c)), np.full(n, float(others)), np.full(n, q),
                                 theta, d, np.random.default_rng(2))
    weight = np.exp(weight - weight.max())
    assert abs((few * weight).sum() / weight.sum() - mean) < 0.1 * deviation + 0.02


def test_many_customers_are_seated_in_steps():
    rng = np.random.default_rng(2)
    one = np.ones(20)
    t = py.seat(np.full(20, 10 ** 12), 10 * one, 1e-3 * one, 1.0, 0.3, rng)
    less = py.seat(np.full(20, 10 ** 6), 10 * one, 1e-3 * one, 1.0, 0.3, rng)
    assert np.all(t >= 1) and np.all(t < 10 ** 6) and t.mean() >= less.mean()


def test_log_gamma_and_packed_arrays():
    x = np.array([1e-3, 0.2, 1, 1.5, 7, 100, 1e7])
    assert np.allclose(py.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)
    for a in ([], [0], [5, 0, 255, 256], [2 ** 62, 1], list(range(1000))):
        assert py.unpack(py.pack(np.array(a, np.int64))).tolist() == a
        assert py.unpack_sorted(py.pack_sorted(np.sort(np.array(a, np.int64)))).tolist() == sorted(a)


def test_cut_keeps_words_whole():
    text = b" one two  three\tfour " + b"x" * 50 + b" end"
    parts = list(py.cut(text, 7))
    assert b"".join(p for p, _ in parts) == text and len(parts) > 3
    assert [last for _, last in parts] == [False] * (len(parts) - 1) + [True]
    assert [w for p, _ in parts for w in p.split()] == text.split()


def test_empty_tables_held_out_tables_and_clashing_columns(spark, docs, no_docs, rows):
    assert py.score_documents(no_docs, held()).collect() == []
    for r in py.score_documents(docs, F.lit(True)).collect():
        assert r.held_out and r.train_tokens == r.n_known == 0 and r.score == r.base_score == 0
    clash = docs.withColumns({c: F.lit("x") for c in ("held", "score", "dest", "uid", "n_tokens")})
    same(collected(py.score_documents(clash, held(), sweeps=0)), brute(rows))


def test_hot_pair_and_hot_context(spark):
    """One context holds most tokens, over many split buckets."""
    rows = [(i, " ".join(f"the w{(i * 37 + j) % 90}" for j in range(60)) + " same same" * 40)
            for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(collected(py.score_documents(df, held(), sweeps=0, **SMALL)), brute(rows))
    got = collected(py.score_documents(df, held(), sweeps=2, **SMALL))
    same(got, brute(rows), base_only=True)
    by_context = defaultdict(list)
    for r in got:
        by_context[r[2]].append(r[6] / r[2])
    assert max(map(max, by_context.values())) < 0


def test_vocabulary_makes_no_python_call_per_word():
    """Words are counted, sorted and numbered as arrays; a loop over them took a fifth of
    the Python tasks' CPU seconds."""
    words = [b"w%d" % (i * 7919 % 6000) for i in range(6000)]
    n = np.arange(6000) % 5
    rows = [r for block, some in ((3, slice(0, 4000)), (9, slice(2000, 6000)))
            for r in (py.row(0, py.WORDS, block, a=b" ".join(words[some] + [py._END]),
                             b=py.pack(np.append(n[some], block))),)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        out = list(py._count_words(4)(iter([pa.Table.from_batches(rows).combine_chunks()
                                            .to_batches()[0]])))
    finally:
        sys.setprofile(None)
    assert calls < 2000
    total = Counter()
    for some in (slice(0, 4000), slice(2000, 6000)):
        total.update(dict(zip(words[some], n[some].tolist())))
    known = sorted((-c, w) for w, c in total.items() if c)
    ids = {w: 2 + 4 * i for i, (_, w) in enumerate(known)} | {py._END: py.END}
    total[py._END] = 12
    first, second = (b.to_pylist()[0] for b in out)
    assert (first["total"], first["x"]) == (total.total(), len(ids))
    assert (second["total"], second["x"]) == (0, 0)
    for r, some in ((first, slice(0, 4000)), (second, slice(2000, 6000))):
        own = words[some] + [py._END]
        assert py.unpack(r["a"]).tolist() == [ids.get(w, py.UNKNOWN) for w in own]
        assert py.unpack(r["b"]).tolist() == [total[w] for w in own]


def test_words_as_arrays_equal_split():
    texts = [b"", b" ", b"a", b"  a\tb\n\x0bc\x0c\rd  ", b"x\x1cy\x85z \x00 \xff\xa0 \x08 \x0e \x1f!",
             b"one two one " * 50]
    for text in texts:
        data, begin, lengths = py.split_words(text)
        words = py.word_array(data, lengths)
        assert words.to_pylist() == text.split()
        assert [text[i:i + n] for i, n in zip(begin, lengths)] == text.split()
    distinct, codes = py.numbered([words, words.slice(1, 3), words.slice(0, 0)])
    want = words.to_pylist() + words.to_pylist()[1:4]
    assert [distinct[int(c)].as_py() for c in codes] == want and len(distinct) == 2
    assert py.joined(words.slice(1, 4)) == b"two one one two"
    data, _, lengths = py.split_words(b"a \n b\tc", only_spaces=True)
    assert py.word_array(data, lengths).to_pylist() == [b"a", b"\n", b"b\tc"]


def test_ranked_equals_unique():
    rng = np.random.default_rng(3)
    for a in (np.array([], np.int64), np.array([7]), np.zeros(16, np.int64), rng.integers(0, 9, 1000),
              rng.integers(0, 1 << 40, 1000), rng.integers(0, 1 << 62, 1000) >> rng.integers(0, 3, 1000)):
        for got, want in zip(py.ranked(a), np.unique(a, return_index=True, return_inverse=True)):
            assert got.tolist() == want.tolist()


def test_blocks_hold_the_words_of_their_pieces(monkeypatch):
    """Whatever the sizes of slices, parts and blocks; ids below 0 and null, empty texts."""
    class Context:
        get = classmethod(lambda c: c)
        partitionId = classmethod(lambda c: 2)

    monkeypatch.setattr(py, "TaskContext", Context)
    texts = [b"A bc  D " * 9, None, b" \n\t" * 40, b"", b"e" * 100, b" f G\x0bh" * 30, b"A"]
    ids = [4, -5, None, 6, 7, 8, 9]
    held = [False, True, False, False, True, False, True]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held),
                                        pa.array(texts, pa.binary())], ["doc_id", "held", "text"])
    want = [[w.lower() for w in (t or b"").split()] + [py._END] for t in texts]
    for limit, tokens, size in ((1 << 20, 1 << 20, 1 << 20), (1, 10, 7), (50, 7, 20), (10, 1, 1000)):
        monkeypatch.setattr(py, "SLICE_BYTES", limit)
        rows = [b.to_pylist()[0] for b in py._blocks(tokens, size)(iter([batch, batch]))]
        got, seen = defaultdict(list), {}
        for block, listed in zip(rows[::2], rows[1::2]):
            words = listed["a"].split(b" ")
            assert block["dest"] == listed["dest"] and listed["x"] == len(set(words)) == len(words)
            codes = py.unpack(block["a"])
            pieces = py.unpack(block["b"]).reshape(6, -1)
            assert block["total"] == len(codes) == pieces[4].sum()
            at, learned = 0, []
            for uid, doc_id, has_id, is_held, n, lead in pieces.T.tolist():
                assert words[lead] == (got[uid] or [py._END])[-1]
                got[uid] += [words[c] for c in codes[at:at + n]]
                learned += [] if is_held else codes[at:at + n].tolist()
                seen[uid] = (doc_id if has_id else None, bool(is_held))
                at += n
            assert py.unpack(listed["b"]).tolist() == np.bincount(
                learned, minlength=len(words)).tolist()
        assert [got[u] for u in sorted(got)] == want * 2
        assert [seen[u] for u in sorted(seen)] == list(zip(ids, held)) * 2
        assert tokens > 1000 or len(rows) > 2
