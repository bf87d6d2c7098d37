"""Toxicity by compression distance (operator 7).

Two zstandard dictionaries are made from labelled text.  The ordinary one is
trained on windows of ordinary documents.  The toxic one holds the same content
followed by the fragments that mark toxic documents: word beginnings whose
document frequency among toxic documents cannot be chance (zstandard's own
trainer picks by plain frequency, and syllables that all text shares crowd the
few telling words out of its dictionaries).  As both share the ordinary part, a
window of ordinary words compresses to the same length under either; a window
with toxic words is shorter under the toxic dictionary.

A document's features are the largest saving of a window, the total of clear
savings, and the savings of single words of the windows that save anything (the
smallest windows, which no neighbour sways); a logistic threshold is calibrated on labelled documents that neither
dictionary has seen.  Scores use nothing but the text.
"""

from __future__ import annotations

import collections
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import ship, text_slices

#: Words of a window.
WINDOW = 10
#: Bounds of the labelled sample (documents of each class), in the order of a hash of their id.
SAMPLE_TOXIC, SAMPLE_ORDINARY = 2500, 6000
ORDINARY_BYTES, TOXIC_BYTES = 1 << 14, 1 << 12
_GRAM = (4, 16)
_LETTERS = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by 5: not to be learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    words = text.lower().encode().split()
    return [b" ".join(words[i:i + size]) for i in range(0, len(words), size)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters(
        write_content_size=0, write_checksum=0, write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, window_log=17, chain_log=16, hash_log=17,
        search_log=6, min_match=4, target_length=8, strategy=zstandard.STRATEGY_BTLAZY2)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


@dataclass
class Model:
    """Dictionary contents and the logistic threshold; ``prior`` alone where a class is absent."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    prior: float = 0.0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def features(self, text: str) -> list[float]:
        """Largest saving of a window, total of clear savings, log of the windows' number;
        largest saving of a word alone, number of words with a clear one."""
        if not hasattr(self, "_pair"):
            # Bytes that no text matches keep the ordinary part at equal distance.
            blank = np.random.default_rng(3).integers(248, 256, len(self.toxic), np.uint8)
            lead = self.ordinary[:40]
            self._pair = (_compressor(self.ordinary + blank.tobytes() + lead),
                          _compressor(self.ordinary + self.toxic + lead))
        plain, toxic = (c.compress for c in self._pair)
        # The lead stands in both dictionaries: every window then holds a match,
        # so that further savings count from the first byte.
        lead = self.ordinary[:40] + b" "
        most, total, n, word, words = 0, 0, 0, 0, 0
        for w in windows(text):
            x = lead + w + b" "
            saved = len(plain(x)) - len(toxic(x))
            most = max(most, saved)
            total += saved if saved >= 3 else 0
            n += 1
            if saved >= 1:
                # The words alone, where no other word sways the parse.
                for one in set(w.split()):
                    x = lead + one + b" "
                    s = len(plain(x)) - len(toxic(x))
                    word = max(word, s)
                    words += s >= 2
        return [most, math.sqrt(total), math.log1p(n), word, math.sqrt(words)]

    def score(self, text: str) -> float:
        if not self.weights or not text.strip():
            return self.prior
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _grams(text: bytes) -> set[bytes]:
    return {w[:k] for w in set(_LETTERS.findall(text))
            for k in range(_GRAM[0], min(len(w), _GRAM[1]) + 1)}


def _distinct(texts: list[str]) -> list[str]:
    """Without near copies, whose words would count as often as there are copies."""
    seen, out = set(), []
    for t in texts:
        words = set(_LETTERS.findall(t.lower().encode()))
        sketch = tuple(min((zlib.crc32(w, k) for w in words), default=0) for k in range(1, 5))
        if sketch not in seen or len(words) < 8:
            seen.add(sketch)
            out.append(t)
    return out


def telling_fragments(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Word beginnings that mark toxic texts, the strongest last."""
    a, b = collections.Counter(), collections.Counter()
    for t in toxic:
        a.update(_grams(t.lower().encode()))
    for t in ordinary:
        b.update(_grams(t.lower().encode()))
    p = len(toxic) / (len(toxic) + len(ordinary))
    tested = [g for g, n in a.items() if n >= 3]

    def log_chance(g: bytes) -> float:
        """Chernoff bound on the chance to see it in so many toxic texts."""
        n, f = a[g] + b[g], a[g] / (a[g] + b[g])
        if f <= p:
            return 0.0
        rest = (1 - f) * math.log((1 - f) / (1 - p)) if f < 1 else 0.0
        return -n * (f * math.log(f / p) + rest)

    limit = -math.log(len(tested) + 10) - 2
    chance = {g: log_chance(g) for g in tested}
    strong = [g for g in tested if chance[g] < limit
              and a[g] / len(toxic) > 8 * (b[g] + 0.5) / len(ordinary)]
    # A beginning adds nothing beside a longer one that (nearly) as many texts hold.
    longer: dict[bytes, int] = {}
    kept = []
    for g in sorted(strong, key=len, reverse=True):
        if a[g] >= 1.3 * longer.get(g, 0):
            kept.append(g)
        for k in range(_GRAM[0], len(g)):
            longer[g[:k]] = max(longer.get(g[:k], 0), a[g])
    return sorted(kept, key=lambda g: -chance[g])


def _logistic(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> list[float]:
    """Newton steps with a slight ridge; ``c`` are the rows' weights."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (c * (y - p)) - 0.05 * w
        hess = (x * (c * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def _dictionaries(rows: list[tuple[str, int, bool]]) -> Model | None:
    """Dictionary contents from labelled texts; None without both classes."""
    toxic = _distinct([t for t, y, _ in rows if y])
    ordinary = _distinct([t for t, y, _ in rows if not y])
    samples = [w for t in ordinary for w in windows(t, 16)[::10]]
    if not toxic or not samples:
        return None
    try:
        trained = zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        trained = b" ".join(samples)[-ORDINARY_BYTES:]
    lead = samples[0][:40].ljust(40)
    marks = b"".join(b" " + g for g in telling_fragments(toxic, ordinary))[-TOXIC_BYTES:] + b" "
    return Model(lead + trained, marks)


def fit(rows: list[tuple[str, int, bool]], stands_for: tuple[float, float] = (1.0, 1.0)
        ) -> Model:
    """A model of (text, label, for calibration) rows: the dictionaries are made from
    the others, the threshold is calibrated on those, which they have not seen.

    A row of class 0 or 1 counts as ``stands_for`` that many labelled documents, so
    prior and threshold are those of the whole, not of the sample's mix.
    """
    weigh = np.array(stands_for, float)
    prior = float(np.average([y for _, y, _ in rows], weights=weigh[[y for _, y, _ in rows]])) \
        if rows else 0.0
    model = _dictionaries([r for r in rows if not r[2]])
    check = [(t, y) for t, y, c in rows if c]
    if model is None or len({y for _, y in check}) < 2:
        # Too few labels to spare some: the same texts serve for both.
        model, check = _dictionaries(rows), [(t, y) for t, y, _ in rows]
    if model is None:
        return Model(prior=prior)
    y = np.array([y for _, y in check], float)
    model.prior = prior
    c = weigh[y.astype(int)]  # on average 1, so that the ridge weighs as much at all sizes
    model.weights = _logistic(np.array([model.features(t) for t, _ in check]), y, c / c.mean())
    return model


def fit_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from a bounded sample of the labelled documents that are not held out.

    The classes are sampled apart; their totals over all these documents weight them.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("toxic").cast("int").alias("y")) \
        .filter(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    total = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    order = F.xxhash64("doc_id", F.lit(7))
    sample = known.filter("y = 1").orderBy(order, "doc_id").limit(SAMPLE_TOXIC).unionByName(
        known.filter("y = 0").orderBy(order, "doc_id").limit(SAMPLE_ORDINARY))
    # The sample's size is bounded above, so broadcasting it is safe.
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .join(F.broadcast(sample), "doc_id").filter("text is not null")
            .select("doc_id", "text", "y", (F.pmod(order, F.lit(5)) == 0).alias("c")).collect())
    stands_for = tuple(max(1.0, total.get(y, 0) / most)
                       for y, most in enumerate((SAMPLE_ORDINARY, SAMPLE_TOXIC)))
    return fit([(r.text, r.y, r.c) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))],
               stands_for)


def _scored(model: Model, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [model.score(t.decode("utf-8", "replace"))
                     for _, texts in text_slices(batch, "__text") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in columns),
                 pa.array(score, pa.float64())], names=[*columns, "__score"])
    return run


def score_toxicity(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (replacing a column of that name).

    Null and empty texts get the share of toxic documents among the labelled ones.
    """
    ship(docs.sparkSession)
    docs = docs.drop(column)
    df = docs.withColumn("__text", F.col("text").cast("binary"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return (df.mapInArrow(_scored(model, docs.columns), f"{fields}, __score double")
            .withColumnRenamed("__score", column))
