from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def fixture_rows() -> list[tuple]:
    """Documents with nulls, empty and long texts, exact and near copies, shared
    passages, repeated rows and odd white space."""
    rng = random.Random(5)
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "one two"), (5, "One  TWO"),
            (None, "a row without an id that has a few words of its own")]
    base = prose(rng, 120)
    passage = prose(rng, 60)
    for i in range(10, 30):
        words = prose(rng, rng.randint(5, 80))
        if i % 3 == 0:
            at = rng.randint(0, len(words))
            words = words[:at] + passage + words[at:]
        rows.append((i, " ".join(words)))
    for i in range(30, 50):
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = "zz" + str(rng.randint(0, 9))
        rows.append((i, (" " if i % 2 else "\n").join(words)))
    rows += [(i, " ".join(base)) for i in range(50, 60)]
    rows += [(60, " ".join(prose(rng, 20_000))), (61, "same words again " * 40),
             (62, "x" * 50_000)]
    rows += [(63, "a repeated row " + " ".join(passage))] * 2
    rows += [(None, " ".join(passage))]
    return rows


@pytest.fixture(scope="session")
def rows():
    return fixture_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
