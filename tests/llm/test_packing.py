from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from navforge.llm.packing import Encoder, make_plan, pack_sequences, shortest_pack_first
from tests.conftest import SF_MEDIUM
from navforge.llm.queries import tokenizer_path, tokenizer_ranks


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def encoded(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_histogram_packing():
    rng = random.Random(1)
    for _ in range(100):
        cap = rng.choice([8, 16, 64, 256])
        h = {rng.randint(1, cap - 1): rng.randint(1, 60) for _ in range(rng.randint(1, 40))}
        packs = shortest_pack_first(h, cap)
        used = Counter()
        for pattern, count in packs:
            assert count > 0 and sum(pattern) <= cap
            for n in pattern:
                used[n] += count
        assert used == Counter(h)


@pytest.mark.parametrize("least_gap", [1, 8])
def test_plan_places_every_rest_once(least_gap):
    rng = random.Random(least_gap)
    for _ in range(100):
        cap = rng.choice([16, 64, 256])
        h = {rng.randint(1, cap - 1): rng.randint(1, 50) for _ in range(rng.randint(1, 40))}
        plan = make_plan(h, cap, least_gap)
        places = defaultdict(list)
        for length, count in h.items():
            for rank in range(count):
                done = 0
                for start, take, seq, at in plan.pieces(length, rank):
                    assert start == done and take > 0
                    done += take
                    places[seq].append((at, take))
                assert done == length
        assert sorted(places) == list(range(plan.sequences))
        for v in places.values():
            at = 0
            for offset, take in sorted(v):
                assert offset == at
                at += take
            assert at <= cap
        if least_gap == 1:  # gaps of any size may be filled
            assert sum(cap - sum(t for _, t in v) for v in places.values()) < 2 * cap


@pytest.mark.parametrize("ranks", [None, tokenizer_ranks()])
def test_pieces_equal_the_tokenizer(spark, docs, rows, tokenizer, ranks):
    got = pack_sequences(docs, tokenizer_path(), length=256, ranks=ranks).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
        assert len(r.ids) == 4 * r.length
    for i in {i for i, _ in rows}:
        texts = Counter(encoded(tokenizer, t).tobytes() for j, t in rows if j == i)
        # Pieces of rows that share an id are told apart by their content.
        starts = Counter((r.start, r.length, r.doc_tokens, bytes(r.ids)) for r in by_doc[i])
        pool = list(starts.elements())
        for ids, n in texts.items():
            for _ in range(n):
                at = 0
                while at < len(ids) // 4:
                    piece = next(p for p in pool if p[0] == at and p[2] == len(ids) // 4
                                 and p[3] == ids[4 * at:4 * (at + p[1])])
                    pool.remove(piece)
                    at += piece[1]
        assert not pool
    for v in by_seq.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 256
    full = sum(sum(n for _, n in v) == 256 for v in by_seq.values())
    assert full >= 0.9 * len(by_seq)


def test_spaces_and_special_strings(spark, tokenizer):
    texts = ["a  b", " a", "a ", "a \n b", "  x y", "<|endoftext|> z <|endoftext|>", "  ",
             "x  y", "don't  'tis it's", "1 2  3", "\x1c x \x1c", "é à", "a\r\n b", "🙂 🙂x",
             "ⅷ ², ½x", "日本 語", "ﬁ ﬂ", "naïve Größe", "a_b c_1", "x\u3000y z", "Ǆ ʰ x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for ranks in (None, tokenizer_ranks()):
        got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in pack_sequences(
            df, tokenizer_path(), ranks=ranks, with_ids=False).collect()}
        for i, t in enumerate(texts):
            ids = encoded(tokenizer, t)
            assert ("<|endoftext|>" in t) == (50256 in ids)
            assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), t


def test_all_documents_equal_the_tokenizer(tokenizer):
    """Both encoders over every document of a table."""
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{SF_MEDIUM}/documents.parquet", columns=["text"])["text"].to_pylist()
    want = [np.array(e.ids, "<u2").tobytes()
            for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for encoder in (Encoder(tokenizer_path()), Encoder(tokenizer_path(), *tokenizer_ranks())):
        assert encoder.encode(texts) == want


def test_other_ranks_are_an_error():
    import public_tokenizers

    other = Encoder(tokenizer_path(), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                    public_tokenizers.PATTERN)
    with pytest.raises(ValueError, match="vocabulary"):
        other.encode(["the information of a document"])


def test_empty_table_and_extra_columns(spark, docs, no_docs):
    assert pack_sequences(no_docs, tokenizer_path()).collect() == []
    clash = docs.filter("doc_id < 5").withColumn("n", F.lit("x")).withColumn("ids", F.lit(1))
    assert pack_sequences(clash, tokenizer_path()).count() == 5
