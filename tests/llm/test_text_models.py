"""Toxicity, personal data, token counts and mixing against brute force or held-out labels."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from navforge.llm import mixing, pii, token_counts, toxicity
from navforge.llm.queries import tokenizer_path
from tests.llm.conftest import prose

INSULTS = ["grobblefunk", "snivelrot", "mudwhelp"]


# -- toxicity -------------------------------------------------------------------
@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        words = prose(rng, rng.randint(20, 120))
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels)


def test_held_out_rule(spark):
    df = spark.range(200).select(toxicity.held_out(F.col("id")).alias("h"), "id")
    for r in df.collect():
        assert r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0)


def test_toxicity_on_held_out_documents(labelled):
    docs, labels, truth = labelled
    model = toxicity.fit_labels(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    held = [(got[i], y) for i, _, y in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((s >= 0.5) == bool(y) for s, y in held)
    assert right >= 0.95 * len(held)


def test_toxicity_learns_from_text_alone(labelled):
    """Held-out labels change nothing; nor do other columns."""
    docs, labels, _ = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")),
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit_labels(docs, labels), toxicity.fit_labels(docs, flipped)
    assert (a.ordinary, a.toxic, a.weights) == (b.ordinary, b.toxic, b.weights)


def test_toxicity_threshold_is_free_of_the_sample_bounds(spark, labelled, monkeypatch):
    """A sample capped for one class keeps the prior and the scores' meaning."""
    docs, labels, truth = labelled
    learned = [y for i, _, y in truth if zlib.crc32(str(i).encode()) % 5]
    whole = toxicity.fit_labels(docs, labels)
    assert whole.prior == pytest.approx(np.mean(learned))
    monkeypatch.setattr(toxicity, "SAMPLE_ORDINARY", sum(learned))
    capped = toxicity.fit_labels(docs, labels)
    assert capped.prior == pytest.approx(whole.prior, abs=1e-9)
    assert toxicity.score_toxicity(docs.limit(1).withColumn("text", F.lit("")),
                                   capped).first().score == capped.prior


def test_toxicity_calibration_weights():
    """A row that stands for four others counts as the four."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 2))
    y = (x[:, 0] + rng.standard_normal(400) > 1).astype(float)
    four = np.where(y == 0, 4.0, 1.0)
    again = np.repeat(np.arange(400), four.astype(int))
    want = toxicity._logistic(x[again], y[again], np.ones(len(again)))
    assert np.allclose(toxicity._logistic(x, y, four), want)
    assert toxicity._logistic(x, y, np.ones(400))[0] > want[0] + 1


def test_toxicity_edge_rows(labelled, docs, no_docs):
    train, labels, _ = labelled
    model = toxicity.fit_labels(train, labels.unionByName(
        labels.limit(2).withColumn("toxic", F.lit(None).cast("int"))))
    clash = docs.withColumn("score", F.lit("x")).withColumn("__row", F.lit(1))
    got = toxicity.score_toxicity(clash, model)
    assert got.columns == [*[c for c in clash.columns if c != "score"], "score"]
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert toxicity.score_toxicity(no_docs, model).collect() == []
    unlabelled = toxicity.fit_labels(train, labels.limit(0))
    assert {r.score for r in toxicity.score_toxicity(docs, unlabelled).collect()} == {0.0}


# -- personal data ---------------------------------------------------------------
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True,
                  "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                  "card": lambda: 14 <= len(digits) <= 19 and pii.luhn(digits),
                  "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        t = "".join(rng.choice("a1.@-+ 25(0)9%é\n") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute_spans(t), t
    number = "4111 1111 1111 1111"
    assert pii.base_spans(f"x {number},") == [("card", 2, 21)]


def test_base_spans_take_linear_time():
    for t in ("a" * 200_000, "1" * 200_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000,
              "a" * 100_000 + "@", "." * 200_000 + "@b"):
        pii.base_spans(t)
        pii.words(t)


def test_skip_edges_carry_labels(spark):
    """A number given in full elsewhere is found again without its prefix."""
    rng = random.Random(2)
    rows = []
    for i in range(300):
        n = f"{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        text = " ".join([*prose(rng, 20), f"+1 (555) {n}", *prose(rng, 20)])
        rows.append((i, text))
    full = "call +1 (555) 271-8281 now " + " ".join(prose(rng, 30))
    rows += [(1000, full + " or 271-8281 later"), (1001, "plain words only"),
             (1002, "version 2.0 of 17 files")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit_personal_data(df)
    got = {r.doc_id: r for r in pii.find_personal_data(df, model, redact=True).collect()}
    r = got[1000]
    assert r.n_phone == 1 and r.added.startswith("phone:")
    _, a, b = r.added.split(":")
    assert r.text[int(a):int(b)] == "271-8281"
    assert "271-8281" not in r.redacted_text and r.redacted_text.count("[PHONE]") == 2
    assert got[1001].spans == "" and got[1002].spans == ""
    assert got[1002].redacted_text == got[1002].text


@pytest.mark.parametrize("text,edges", [
    ("+1-555-271-8281 or 271-8281", [(0, 1)]),  # in full, later in part
    ("+15552718281 or (555) 271-8281 or 271-8281", [(0, 2), (2, 3)]),
    ("call 555 271 8281 or 555-271-8281", [(2, 3)]),  # split, later in one word
    ("10.0.0.1 is 10-0-0-1, not 10.0.0.2", [(0, 1)]),
    ("me@example.org ME@example.org", [(0, 1)]),
    ("271-8281 or 271-8282", []), ("555 and 271 and 8281 or 5552718281", []),
])
def test_skip_edges_join_parts_of_a_number(text, edges):
    assert pii.Graph(text, pii.base_spans(text)).skip == edges


def test_propagation_is_exact_on_trees():
    """Against the sum over all labellings of a small tree."""
    rng = np.random.default_rng(0)
    n, k = 5, pii.LABELS
    unary = rng.standard_normal((n, k))
    edges = np.array([(0, 1), (1, 2), (1, 3), (3, 4)])
    psi = rng.standard_normal((len(edges), k, k))
    total = np.zeros((n, k))
    for y in np.ndindex(*[k] * n):
        w = math.exp(sum(unary[i, y[i]] for i in range(n))
                     + sum(psi[e, y[i], y[j]] for e, (i, j) in enumerate(edges)))
        for i in range(n):
            total[i, y[i]] += w
    want = total / total.sum(axis=1, keepdims=True)
    rounds, pii.ROUNDS = pii.ROUNDS, 60
    try:
        assert np.allclose(pii.marginals(unary, edges, psi), want, atol=1e-6)
    finally:
        pii.ROUNDS = rounds


def test_personal_data_edge_rows(docs, no_docs, rows):
    model = pii.fit_personal_data(docs)
    clash = docs.withColumn("spans", F.lit(1)).withColumn("n_ip", F.lit("x"))
    got = pii.find_personal_data(clash, model).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert all(r.base_sha256 == empty and r.n_email == 0 for r in got)
    assert pii.find_personal_data(no_docs, pii.fit_personal_data(no_docs)).collect() == []


# -- token counts ------------------------------------------------------------------
@pytest.fixture(scope="module")
def pieces():
    return token_counts.load_pieces(tokenizer_path("piece_bpe_32k.model"))


def test_token_counts_equal_word_by_word(docs, rows, pieces):
    longest = max(map(len, pieces))
    got = token_counts.count_tokens(docs.withColumn("n_tokens", F.lit("clash")),
                                    tokenizer_path("piece_bpe_32k.model")).collect()
    want = Counter()
    memo: dict[bytes, tuple] = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for w in words:
            if w not in memo and len(w) <= 2000:
                memo[w] = token_counts.one_word(token_counts.MARK + w, pieces, longest)
        if all(w in memo for w in words):
            want[(i, len(words), sum(memo[w][0] for w in words))] += 1
    have = Counter((r.doc_id, r.n_pretokens, r.n_tokens) for r in got)
    assert not want - have and sum(have.values()) == len(rows)
    for r in got:
        words = (r.text or "").encode().split()
        if all(w in memo for w in words):
            assert math.isclose(r.log_probability, sum(memo[w][1] for w in words),
                                rel_tol=1e-9, abs_tol=1e-9)


def test_trie_shares_prefixes(pieces):
    vocabulary = token_counts.Vocabulary(pieces)
    words = sorted({token_counts.MARK + w.encode() for w in
                    ["in", "inform", "information", "infor", "é", "éa", "a\0", "a", "\0", "the",
                     "there", "x" * 60]})
    tokens, score = token_counts.trie_counts(words, vocabulary)
    for w, n, s in zip(words, tokens, score):
        want = token_counts.one_word(w, pieces, vocabulary.longest)
        assert (n, pytest.approx(s)) == (want[0], want[1])


@pytest.mark.parametrize("few,block", [(256, 1 << 16), (3, 7), (1, 50), (10**9, 11)])
def test_trie_scores_words_of_any_length(pieces, monkeypatch, few, block):
    """Depths computed together, words computed alone, blocks that cut a word: all equal."""
    monkeypatch.setattr(token_counts, "FEW", few)
    monkeypatch.setattr(token_counts, "BLOCK", block)
    rng, some = random.Random(4), [p for p in list(pieces)[:2000]]
    words = {b"".join(rng.choice(some) for _ in range(rng.choice([1, 2, 8, 60])))
             for _ in range(150)}
    words |= {w + b"xx" for w in list(words)[:40]} | {w + b"yabc" for w in list(words)[:40]}
    words |= {b"a" * 300, b"a" * 301, bytes(range(256)), "一二".encode() * 90}
    words = sorted(words)
    vocabulary = token_counts.Vocabulary(pieces)
    tokens, score = token_counts.trie_counts(words, vocabulary)
    for w, n, s in zip(words, tokens, score):
        want = token_counts.one_word(w, pieces, vocabulary.longest)
        assert n == want[0] and math.isclose(s, want[1], rel_tol=1e-9)


def test_bytes_shared_with_the_word_before():
    words = sorted({b"a" * n + t for n in (0, 1, 63, 64, 65, 200) for t in (b"", b"\0", b"b")} - {b""})
    want = [0] + [len(os.path.commonprefix([a, b])) for a, b in zip(words, words[1:])]
    assert token_counts.shared_bytes(words).tolist() == want


def test_token_counts_empty(no_docs):
    assert token_counts.count_tokens(no_docs, tokenizer_path("piece_bpe_32k.model")).collect() == []


# -- mixing ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    ends = {"a": ["ing", "ed"], "b": ["ung", "heit"], "c": ["ción", "ar"]}
    rows, domains = [], []
    for i in range(400):
        d = "aaaaaabbbc"[i % 10]
        words = ["".join(rng.choice("klmn") for _ in range(3)) + rng.choice(ends[d])
                 for _ in range(rng.randint(1, 60))]
        rows.append((i, " ".join(words), "clash"))
        domains.append((i, d))
    rows += [(900, None, ""), (901, "", ""), (None, "kkking", ""), (0, rows[0][1], "clash"),
             (902, "kkking lllung " * 4000, "")]
    return (spark.createDataFrame(rows, "doc_id long, text string, rate string"),
            spark.createDataFrame(domains[:250], "doc_id long, domain string"), rows, domains)


def brute_rates(tokens, p, share):
    """Projected gradient in numpy."""
    rate = np.ones(len(tokens))
    goal = np.array(share) / sum(share)
    first = p.T @ tokens
    for _ in range(mixing.STEPS):
        excess = p.T @ (rate * tokens) - goal * first.sum()
        if np.abs(excess).max() <= mixing.TOLERANCE * first.sum():
            break
        rate = np.maximum(0, rate - p @ (excess / first))
    return rate


def test_mixing(corpus):
    docs, labelled, rows, domains = corpus
    targets = {"a": 0.2, "b": 0.3, "c": 0.5}
    got = mixing.mix_to_targets(docs, labelled, targets).collect()
    assert len(got) == len(rows)
    p = np.array([[r.p_a, r.p_b, r.p_c] for r in got])
    n = np.array([r.n_tokens for r in got], float)
    rate = np.array([r.rate for r in got])
    assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all()
    assert sorted(n) == sorted(len((t or "").split()) for _, t, _ in rows)
    reached = p.T @ (rate * n) / n.sum()
    assert np.allclose(reached, list(targets.values()), atol=2 * mixing.TOLERANCE)
    assert np.allclose(rate, brute_rates(n, p, list(targets.values())), atol=1e-9)
    truth = dict(domains)
    unseen = [r for r in got if r.doc_id in truth and 250 <= r.doc_id and r.n_tokens >= 5]
    right = sum("abc"[int(np.argmax([r.p_a, r.p_b, r.p_c]))] == truth[r.doc_id] for r in unseen)
    assert right >= 0.97 * len(unseen)
    for r in got:
        assert r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
    assert abs(sum(r.copies for r in got) - rate.sum()) < 4 * math.sqrt(len(got))


def test_mixing_uses_no_python(corpus):
    docs, labelled, _, _ = corpus
    out = mixing.mix_to_targets(docs, labelled, {"a": 1.0, "b": 1.0})
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mixing_edge_tables(corpus, no_docs):
    docs, labelled, _, _ = corpus
    assert mixing.mix_to_targets(no_docs, labelled, {"a": 1.0, "b": 1.0}).collect() == []
    even = mixing.mix_to_targets(docs, labelled.limit(0), {"a": 1.0, "b": 1.0}).collect()
    assert all(math.isclose(r.rate, 1.0) and r.copies == 1 for r in even)
