from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from navforge.llm.common import Scratch
from navforge.llm.components import connected_components
from navforge.llm import minhash_dedup
from navforge.llm.minhash_dedup import near_duplicates


def brute(rows, k, per_cent=80):
    sets: dict[int, list[set]] = {}
    for i, t in rows:
        w = bytes(t or "", "utf-8").lower().split()
        s = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else \
            ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    label = {i: i for i in sets if i is not None}
    ids = sorted(label)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= per_cent * len(s | t)
                             for s in sets[a] for t in sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else (find(i) if s else i))
                   for i in sets for s in sets[i])


@pytest.mark.parametrize("k", [2, 5])
def test_equals_brute_force(docs, rows, k):
    got = near_duplicates(docs.withColumn("component_id", F.lit("clash")), words=k).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, k)
    for r in got:
        assert r.kept == (None if r.doc_id is None else r.doc_id == r.component_id)


def test_chain_of_links_needs_more_rounds(spark, monkeypatch):
    """Neighbours of a chain are linked, its ends are not; tiles smaller than the bucket."""
    monkeypatch.setattr(minhash_dedup, "TILE", 4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[8 * i:8 * i + 120])) for i in range(30)]
    rows += [(100 + i, " ".join(words[:100] + [f"x{i}"] * 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(df, words=2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 2)


def test_tiles_are_bounded_by_shingles(spark, monkeypatch):
    """Few long documents make as many tiles as many short ones; no link is lost."""
    monkeypatch.setattr(minhash_dedup, "TILE_SHINGLES", 300)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[8 * i:8 * i + 120])) for i in range(30)]
    rows += [(100 + i, " ".join(words[:100] + [f"x{i}"] * 3)) for i in range(40)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"),
                          words=2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 2)


@pytest.mark.parametrize("piece", [1, 7])
def test_pieces_of_a_tile_are_all_read(piece, monkeypatch):
    """A tile that arrives in several batches, and a combined table of several batches
    (as columns beyond 2 GiB are), keep every row."""
    text = "a b c d e f g h".encode()
    whole = pa.RecordBatch.from_pydict({
        "key": [1] * 7 + [2] * 3, "i": [0] * 10, "j": [0] * 10, "node": list(range(10)),
        "text": [text] * 10})
    batches = [whole.slice(i, piece) for i in range(0, 10, piece)]
    groups = list(minhash_dedup.sorted_groups(iter(batches), ["key", "i", "j"]))
    assert [g.column(3).to_pylist() for g in groups] == [list(range(7)), [7, 8, 9]]
    held = []
    monkeypatch.setattr(minhash_dedup, "_whole", held.append)
    edges = [e for b in minhash_dedup._exact(2, 80)(iter(batches)) for e in b.to_pylist()]
    assert not held  # no tile of texts is built
    assert {(e["a"], e["b"]) for e in edges} == {(n, 0) for n in range(1, 7)} | {(8, 7), (9, 7)}


def test_combined_bytes_beyond_32_bit_offsets():
    """Bytes that several 32-bit arrays would be needed for stay one batch (no large data:
    the offsets' width decides)."""
    one = pa.RecordBatch.from_pydict({"key": [1], "text": [b"x"]})
    [g] = minhash_dedup.sorted_groups(iter([one, one]), ["key"])
    assert g.num_rows == 2 and pa.types.is_large_binary(g.schema.field("text").type)


def test_texts_of_one_id_are_one_node(spark):
    """Linked by the id alone, also where none of its texts has the id as its node."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(3, a), (4, b), (5, a), (5, c), (6, c), (7, a), (7, b), (8, d), (9, d), (9, None),
            (2, d), (2, ""), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(df, words=2, text_hash=True)
    want = {(r.doc_id, r.h) for r in df.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    got = got.collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 2)
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5, 6, 7)} == {3}
    assert {(r.doc_id, r.text_hash) for r in got} == want


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 7)]
    edges += [(1000, 1000 + i) for i in range(1, 300)] + [(5, 4), (5, 4)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, Scratch(spark, "t")).collect()}
    want = {i: 0 for i in range(51)} | {100: 100, 150: 100, 200: 100} | \
        {1000 + i: 1000 for i in range(300)}
    assert got == want
    none = connected_components(df.limit(0), Scratch(spark, "t"))
    assert none.collect() == []


def thue_morse(n, a="a", b="b"):
    word = a
    while len(word) < n:
        word += word.translate(str.maketrans(a + b, b + a))
    return word


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_of_thue_morse_letters_differ(spark, size):
    """Sequences on which hashes that are polynomials modulo a power of two collide."""
    x, y = thue_morse(size), thue_morse(size, "b", "a")
    rows = [(1, " ".join([x, "c"] * 12)), (2, " ".join([y, "c"] * 12)),
            (3, f"{x} {y} {x}"), (4, f"{y} {x} {y} q")]
    rows += [(10 + i, " ".join({"a": "u", "b": "v"}[c] for c in w) + " ." * i)
             for i, w in enumerate((x, y))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k in (2, 5):
        got = near_duplicates(df, words=k).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, k)


def test_large_group_in_several_components(spark, monkeypatch):
    """A bucket's largest component meets the others in tiles; no link is lost."""
    monkeypatch.setattr(minhash_dedup, "TILE", 8)
    rng = random.Random(6)
    common = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        some = list(common)
        for _ in range(rng.randint(0, 9)):
            some[rng.randrange(60)] = f"x{rng.randint(0, 5)}"
        rows.append((i, " ".join(some)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k in (2, 5):
        got = near_duplicates(df, words=k).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, k)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 27])
def test_of_ids_is_exact_with_any_bitmap(spark, monkeypatch, bits):
    monkeypatch.setattr(minhash_dedup, "FILTER_BITS", bits)
    df = spark.range(20_000).select((F.col("id") - 10_000).alias("node"), F.col("id").alias("v"))
    ids = df.filter("node % 3 = 0").select("node")
    got = minhash_dedup.of_ids(df.union(df.limit(0)), ids)
    assert got.count() == ids.count() and got.filter("node % 3 <> 0").isEmpty()
    assert minhash_dedup.of_ids(df, ids.limit(0)).isEmpty()
