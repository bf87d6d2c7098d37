from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from navforge.llm.filter_audit import audit_filters, text_mask


def failing(rows):
    """Filters that each (doc_id, lang, text) fails."""
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, _, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                    "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                    "D": bool(re.search(r"[#$%&*|]", t)),
                    "E": i is not None and i > first[t]})
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for r, f in zip(rows, failing(rows)):
        parts[r[1] or ""].append((r[0], f))
    out = {}
    for part, docs in parts.items():
        gone = defaultdict(int)
        for order in permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                removed = [d for d in left if d[1][x]]
                left = [d for d in left if not d[1][x]]
                gone[x] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(d[1][x] for d in docs) - len(removed),
                    sum(d[1][x] and sum(d[1].values()) == 1 for d in docs),
                    sum(d[0] in good for d in removed), sum(d[0] in toxic for d in removed)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(gone[order[step - 1]])
    return out


def audited(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails,
                                               r.good_lost, r.toxic_lost, r.shapley]
            for r in df.collect()}


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def audit_rows(rows):
    rng = random.Random(8)
    out = [(i, rng.choice(["en", "de", "", None]), t) for i, t in rows]
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    for i in range(100, 160):
        some = rng.sample(words, rng.randint(80, 140))
        if rng.random() < 0.4:
            some += some[:60]
        if rng.random() < 0.4:
            some = [w.upper() for w in some]
        if rng.random() < 0.4:
            some.append(rng.choice("#$%&*|"))
        out.append((i, rng.choice(["en", "de", None]), " ".join(some)))
        if rng.random() < 0.3:
            out.append((i + 100, "en", out[-1][2]))
    return out


def test_equals_brute_force(spark, audit_rows):
    rng = random.Random(9)
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1])) for r in audit_rows
              if r[0] is not None and rng.random() < 0.7] + [(None, 1, 1), (9999, 1, 1), (10, 1, 1)]
    docs = spark.createDataFrame(audit_rows, "doc_id long, lang string, text string")
    got = audited(audit_filters(docs.repartition(7), spark.createDataFrame(labels, LABELS)))
    assert got == brute(audit_rows, labels)
    assert len(got) == 600 * len({r[1] or "" for r in audit_rows})


def test_bounds_of_the_filters():
    def fails(text):
        return {x for i, x in enumerate("ABCD") if text_mask(text.encode()) >> i & 1}

    ninety = [f"w{i}" for i in range(90)]
    assert "A" not in fails(" ".join(ninety + ["x"] * 10))
    assert "A" in fails(" ".join(ninety + ["x"] * 9))
    assert "B" not in fails(" ".join([f"w{i}" for i in range(79)] + ["x"] * 21))
    assert "B" in fails(" ".join([f"w{i}" for i in range(78)] + ["x"] * 22))
    assert "B" not in fails("Aa aA AA aa")  # case counts
    assert "C" not in fails("A" + "é" * 9) and "C" in fails("A" + "é" * 8)  # code points
    assert "C" not in fails("É" * 10)
    assert "D" in fails("a|b") and "D" not in fails("a_b@c")
    assert "A" not in fails("  " * 100)  # U+00A0 is part of a word


def test_empty_tables_and_clashing_columns(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(3, 1, 1)], LABELS)
    assert audit_filters(no_docs, labels).collect() == []
    full = [(i, "en", t) for i, t in rows]
    clash = docs.withColumns({c: F.lit(5) for c in ("part", "mask", "n", "good", "first", "digest")})
    got = audited(audit_filters(clash, labels.withColumn("good", F.lit("x"))))
    assert got == brute(full, [(3, 1, 1)])
    assert audited(audit_filters(docs, labels.limit(0))) == brute(full, [])
