"""Personal data by a skip-chain conditional random field (operator 10).

Fixed patterns find the base spans.  A field over the words that hold a digit
or an ``@`` (other words are outside by definition of the four kinds) then adds
spans the patterns miss: a phone number given in full once and in part later, a
card number that is torn apart, an address whose dots are spelled differently.

The graph of a document has the words as nodes, *chain* edges between words
that touch but for white space, and *skip* edges from each word to the next
word of the document that repeats it or resembles it (the same last 7 or 10
digits, also of a number in several words; the same four parts of an address;
same letters but for case and punctuation).  Labels are the kinds and ``outside``.
Parameters are piecewise estimates from counts over all documents, with the
base spans as labels: how often a word of a certain shape has a label, how
often the ends of chain and of skip edges agree.  Loopy belief propagation, all
documents of a batch as one graph, gives marginals; a word of at least
``CERTAIN`` for a kind becomes a span.  Base spans are observed and stay.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import ship, text_slices

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LABELS = len(KINDS) + 1
CERTAIN = 0.9
ROUNDS = 12
DAMPING = 0.3

#: Patterns of the base spans (fixed values); the @ pattern holds what follows the @.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_REST = re.compile(r"\S*")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """As the leftmost matches of the whole pattern, in linear time: an address has
    one @, and its local part is the longest run before it."""
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield "email", start, m.end()
            end = m.end()
        at += 1
        at = max(at, end)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its test."""
    out = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def words(text: str) -> list[tuple[int, int]]:
    """Places of the words (between white space) that hold a digit or an @."""
    out, at = [], 0
    while m := _SIGN.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _REST.match(text, m.start()).end()
        out.append((start, end))
        at = end
    return out


def shape(word: str) -> str:
    """A bounded description: number of digits, marks, letters, validity."""
    digits = re.sub("[^0-9]", "", word)
    n = len(digits)
    bucket = n if n <= 4 else 5 + sum(n >= k for k in (8, 10, 14, 16, 17, 20))
    runs = min(len(re.findall("[0-9]+", word)), 5)
    letters = sum(c.isalpha() for c in word)
    marks = "".join(c for c in "@.-+(" if c in word)
    valid = "L" if 14 <= n <= 19 and luhn(digits) else ""
    small = "B" if all(len(p) <= 3 and int(p) <= 255 for p in re.findall("[0-9]+", word)) else ""
    return f"{bucket}:{runs}:{'a' * min(letters, 2)}:{marks}:{valid}{small}"


def likenesses(word: str, before: str = "") -> list[str]:
    """Words that share a likeness are joined by skip edges.  ``before`` are the digits
    of the words that the word may carry on: parts of a number resemble its end."""
    digits = re.sub("[^0-9]", "", word)
    plain = re.sub(r"[\W_]", "", word).lower()
    if any(c.isalpha() for c in word):
        return ["w" + plain] if len(plain) >= 6 else []
    out = []
    joined = (before + digits)[-10:] if len(digits) < 10 else digits[-10:]
    if len(joined) >= 7:
        out.append("d" + joined[-7:])
    if len(joined) == 10:
        out.append("d" + joined)
    if len(digits) < 7 and len(plain) >= 6:
        out.append("w" + plain)
    parts = re.findall("[0-9]+", word)
    if len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts):
        out.append("i" + ".".join(str(int(p)) for p in parts))
    return out


class Graph:
    """The words of one text: places, labels of the base spans, edges."""

    def __init__(self, text: str, spans: list[Span]):
        self.places = words(text)
        self.tokens = [text[a:b] for a, b in self.places]
        self.labels = [OUTSIDE] * len(self.places)
        i = 0
        for kind, a, b in sorted(spans, key=lambda s: s[1]):
            while i < len(self.places) and self.places[i][1] <= a:
                i += 1
            j = i
            while j < len(self.places) and self.places[j][0] < b:
                self.labels[j] = KINDS.index(kind)
                j += 1
        self.chain = [(i, i + 1) for i in range(len(self.places) - 1)
                      if text[self.places[i][1]:self.places[i + 1][0]].isspace()
                      or self.places[i][1] == self.places[i + 1][0]]
        last: dict[str, int] = {}
        self.skip = []
        touches = {j for _, j in self.chain}
        before = ""
        for i, t in enumerate(self.tokens):
            if i not in touches:
                before = ""
            keys = likenesses(t, before)
            self.skip += [(j, i) for j in sorted({last[k] for k in keys if k in last})]
            last.update((k, i) for k in keys)
            number = "@" not in t and not any(c.isalpha() for c in t)
            before = (before + re.sub("[^0-9]", "", t))[-10:] if number else ""


@dataclass
class Model:
    unary: dict[str, list[float]]
    other: list[float]  # of a shape that no document has
    chain: list[list[float]]
    skip: list[list[float]]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for _, texts in text_slices(batch, "text"):
            for t in texts:
                text = t.decode("utf-8", "replace")
                if not _SIGN.search(text):
                    continue
                g = Graph(text, base_spans(text))
                found.update(("shape", shape(w), y, 0) for w, y in zip(g.tokens, g.labels))
                for what, edges in (("chain", g.chain), ("skip", g.skip)):
                    found.update((what, "", g.labels[i], g.labels[j]) for i, j in edges)
        if found:
            yield pa.RecordBatch.from_pydict({
                "what": [k[0] for k in found], "shape": [k[1] for k in found],
                "x": pa.array([k[2] for k in found], pa.int32()),
                "y": pa.array([k[3] for k in found], pa.int32()),
                "n": pa.array(list(found.values()), pa.int64())})


def _pairwise(n: np.ndarray, agree: float) -> list[list[float]]:
    """Log potentials of an edge: how much likelier two labels meet than by chance.
    ``agree`` pseudo-counts on equal labels stand for the prior of consistency."""
    n = n + n.T + 0.5 + agree * np.eye(LABELS)
    p = n / n.sum()
    one = p.sum(axis=1)
    return np.clip(np.log(p / np.outer(one, one)), -4, 4).tolist()


def fit_personal_data(docs: DataFrame) -> Model:
    """Potentials from counts over all documents; what reaches the driver is bounded
    by the number of shapes times labels."""
    ship(docs.sparkSession)
    rows = (docs.select(F.col("text").cast("binary").alias("text"))
            .mapInArrow(_counts, "what string, shape string, x int, y int, n long")
            .groupBy("what", "shape", "x", "y").agg(F.sum("n").alias("n")).collect())
    shapes: dict[str, np.ndarray] = {}
    pair = {"chain": np.zeros((LABELS, LABELS)), "skip": np.zeros((LABELS, LABELS))}
    for r in sorted(rows, key=lambda r: (r.what, r.shape, r.x, r.y)):
        if r.what == "shape":
            shapes.setdefault(r["shape"], np.zeros(LABELS))[r.x] += r.n
        else:
            pair[r.what][r.x, r.y] += r.n
    prior = np.full(LABELS, 0.05)
    prior[OUTSIDE] = 1.0
    unary = {s: np.log((c + prior) / (c + prior).sum()).tolist() for s, c in shapes.items()}
    return Model(unary, np.log(prior / prior.sum()).tolist(), _pairwise(pair["chain"], 0.0),
                 _pairwise(pair["skip"], 5.0))


def marginals(unary: np.ndarray, edges: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Loopy belief propagation.  ``edges`` are (i, j) rows, ``potential`` their log
    potentials [edge, label of i, label of j]; exact where the graph has no cycle."""
    if not len(edges):
        b = np.exp(unary - unary.max(axis=1, keepdims=True))
        return b / b.sum(axis=1, keepdims=True)
    i, j = edges.T
    source, target = np.concatenate([i, j]), np.concatenate([j, i])
    psi = np.concatenate([potential, potential.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(i)) + len(i), np.arange(len(i))])
    m = np.zeros((len(source), unary.shape[1]))
    for r in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, m)
        z = (belief[source] - m[back])[:, :, None] + psi
        top = z.max(axis=1, keepdims=True)
        new = (top + np.log(np.exp(z - top).sum(axis=1, keepdims=True)))[:, 0]
        new -= new.max(axis=1, keepdims=True)
        m = new if r == 0 else DAMPING * m + (1 - DAMPING) * new
    belief = unary.copy()
    np.add.at(belief, target, m)
    b = np.exp(belief - belief.max(axis=1, keepdims=True))
    return b / b.sum(axis=1, keepdims=True)


#: Most digits of a number that words make up together.
_DIGITS = {"card": 19, "phone": 15}


def _one(kind: str, before: Span, text: str, start: int, end: int) -> bool:
    """Whether a word carries on the span before it: only numbers are written in parts."""
    return (kind in _DIGITS and before[0] == kind and text[before[2]:start].isspace()
            and sum(c in "0123456789" for c in text[before[1]:end]) <= _DIGITS[kind])


def all_spans(texts: list[str], model: Model) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t) if _SIGN.search(t) else [] for t in texts]
    graphs = [Graph(t, s) if _SIGN.search(t) else None for t, s in zip(texts, base)]
    unary, edges, kinds, first = [], [], [], []
    for g in graphs:
        first.append(len(unary))
        if g is None:
            continue
        n = len(unary)
        for w, y in zip(g.tokens, g.labels):
            if y != OUTSIDE:
                seen = np.full(LABELS, -50.0)
                seen[y] = 0.0
                unary.append(seen)
            else:
                unary.append(np.array(model.unary.get(shape(w), model.other)))
        for what, e in ((0, g.chain), (1, g.skip)):
            edges += [(n + a, n + b) for a, b in e]
            kinds += [what] * len(e)
    if not unary:
        return [(b, []) for b in base]
    table = np.array([model.chain, model.skip])
    p = marginals(np.array(unary), np.array(edges, np.int64).reshape(-1, 2),
                  table[np.array(kinds, np.int64)])
    out = []
    for t, g, spans, n in zip(texts, graphs, base, first):
        added: list[Span] = []
        for k, (a, b) in enumerate(g.places if g else ()):
            if g.labels[k] != OUTSIDE:
                continue
            y = int(p[n + k].argmax())
            if y == OUTSIDE or p[n + k, y] < CERTAIN:
                continue
            while a < b and not t[a].isalnum() and t[a] not in "+(":
                a += 1
            while b > a and not t[b - 1].isalnum():
                b -= 1
            if a < b:
                if added and _one(KINDS[y], added[-1], t, a, b):
                    added[-1] = (KINDS[y], added[-1][1], b)
                else:
                    added.append((KINDS[y], a, b))
        out.append((spans, added))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in
                    sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each maximal run of overlapping spans as one mark, [KIND] of the
    span that starts it."""
    out, at, end = [], 0, 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[at:a], f"[{k.upper()}]"]
        end = at = max(end, b)
    return "".join(out) + text[at:]


_NEW = (("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()),
        ("n_phone", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
        ("added", pa.string()), ("redacted_text", pa.string()))


def _found(model: Model, columns: list[str], redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in text_slices(batch, "__text"):
                texts = [t.decode("utf-8", "replace") for t in raw]
                found = all_spans(texts, model)
                rows = []
                for t, (base, added) in zip(texts, found):
                    n = Counter(k for k, _, _ in base)
                    rows.append((*(n[k] for k in KINDS),
                                 hashlib.sha256(joined(base).encode()).hexdigest(),
                                 joined(base + added), joined(added),
                                 redacted(t, base + added) if redact else None))
                new = zip(zip(*rows), _NEW)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in columns),
                     *(pa.array(v, f[1]) for v, f in new)],
                    names=[*columns, *(f"__{f[0]}" for f in _NEW)])
    return run


def find_personal_data(docs: DataFrame, model: Model, redact: bool = False) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans,
    added and, with ``redact``, redacted_text (null text: empty).  Columns of these
    names in ``docs`` are replaced."""
    ship(docs.sparkSession)
    docs = docs.drop(*(f[0] for f in _NEW))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    ddl = ", ".join(f"__{name} {'long' if t == pa.int64() else 'string'}" for name, t in _NEW)
    out = (docs.withColumn("__text", F.col("text").cast("binary"))
           .mapInArrow(_found(model, docs.columns, redact), f"{fields}, {ddl}")
           .withColumnsRenamed({f"__{f[0]}": f[0] for f in _NEW}))
    return out if redact else out.drop("redacted_text")
