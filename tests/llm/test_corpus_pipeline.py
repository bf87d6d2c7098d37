"""The corpus pipeline and the registered queries."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from navforge.llm import pii, toxicity
from navforge.llm.common import Scratch, table
from navforge.llm.queries import oracle_sql, queries, tokenizer_path
from tests.conftest import SF_MEDIUM, SF_SMALL
from tests.llm.test_minhash_dedup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage kept, from the documents of the smallest tables."""
    scratch = Scratch(spark, "test-corpus")
    out = {"documents": table(spark, SF_SMALL, "documents")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = scratch.write(stage(spark, docs, SF_SMALL), name)
    return out


def test_stage_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == COLUMNS


def test_toxicity_stage(spark, stages):
    model = toxicity.fit_labels(stages["documents"], table(spark, SF_SMALL, "labels"))
    want = Counter(tuple(r) for r in stages["documents"].collect()
                   if model.score(r.text or "") < 0.5)
    assert Counter(map(tuple, stages["toxicity"].collect())) == want
    assert 0 < stages["documents"].count() - sum(want.values()) < 40


def test_near_duplicate_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages["toxicity"].collect()]
    want = {i for i, _, c in brute(rows, 5) if i == c}
    assert Counter(r.doc_id for r in stages["near_duplicates"].collect()) == Counter(want)


def test_every_group_keeps_one_row(spark):
    """Ids with two texts: no group loses all its rows, none keeps two, and words go
    before none."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (5, b), (6, None), (6, c), (7, c), (7, ""), (8, ""), (None, a)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, "
                               "lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, df, SF_SMALL)
    assert got.columns == COLUMNS
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(
        [(3, a), (6, c), (7, ""), (8, ""), (None, a)])


def test_personal_data_stage(stages):
    model = pii.fit_personal_data(stages["near_duplicates"])
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    changed = 0
    for r in stages["personal_data"].collect():
        old = before.pop(r.doc_id)
        [(base, added)] = pii.all_spans([old.text], model)
        assert r.text == pii.redacted(old.text, base + added)
        assert r.n_chars == len(r.text) and r.lang == old.lang
        assert not pii.base_spans(r.text)
        changed += r.text != old.text
    assert not before and changed


def test_mixing_stage(stages):
    before = {r.doc_id: r.text for r in stages["personal_data"].collect()}
    rows = stages["mixing"].collect()
    assert all(before[r.doc_id] == r.text for r in rows)
    assert 0.5 * len(before) < len(rows) < 2 * len(before)


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    ids = {r.doc_id: np.array(t.encode(r.text, add_special_tokens=False).ids + [1], "<u4")
           for r in stages["mixing"].collect()}
    times = Counter(r.doc_id for r in stages["mixing"].collect())
    total, sequences = Counter(), defaultdict(list)
    for r in stages["packing"].collect():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert (zlib.crc32(part.tobytes()), r.doc_tokens) == (r.ids_crc32, len(ids[r.doc_id]))
        total[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert total == Counter({i: times[i] * len(ids[i]) for i in times})
    for v in sequences.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 2048


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    order = sorted(map(tuple, stages["packing"].collect()))
    assert sorted(map(tuple, got.collect())) == order


def test_stages_on_edge_tables(spark, docs, no_docs):
    """Nulls, empty and repeated rows, and no rows at all, pass through every stage."""
    for start in (docs, no_docs):
        rows = start
        scratch = Scratch(spark, "test-edge")
        for name, stage in corpus_pipeline.STAGES:
            rows = scratch.write(stage(spark, rows, SF_SMALL), name)
        assert (rows.count() > 0) == (start is docs)


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MEDIUM}/{t}.parquet')")
    got = queries()[name](spark, SF_MEDIUM)
    rel = con.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(rel.columns)
    pick = sorted(got.columns)
    want = Counter(tuple(_norm(r[rel.columns.index(c)]) for c in pick) for r in rel.fetchall())
    assert Counter(tuple(_norm(r[c]) for c in pick) for r in got.collect()) == want


def test_every_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries())
    assert numbers == list(range(1, 14))


def test_op7_columns(spark):
    df = queries()["op7_toxicity"](spark, SF_SMALL)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"),
                         ("predicted", "int")]
    assert df.count() == df.filter((F.col("score") >= 0.5) == (F.col("predicted") == 1)).count()


def test_op10_columns(spark):
    df = queries()["op10_personal_data"](spark, SF_SMALL)
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
