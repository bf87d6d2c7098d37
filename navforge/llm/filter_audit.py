"""Interaction audit of filters by contingency tensors (operator 13).

Every document is reduced to one bit a filter (set: it fails).  Per part, the
documents are counted in a tensor of shape 2 x 2 x 2 x 2 x 2, one axis a filter;
the same is done for the good and for the toxic ones.  Whatever happens in an
order of the filters is a contraction of that tensor: an axis is contracted with
(1, 0) to select what passes, (0, 1) what fails, (1, 1) all.  So the documents
are read once, and 120 orders of five steps cost the same however many there are.

A repeated text is found by its 128-bit digest: the smallest id of each digest is
an aggregate with map-side combining, and documents are matched to it by digest
and id together, a key that few rows share even if one text fills the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, text_slices

FILTERS = "ABCDE"
#: Thresholds of the filters (fixed values).
MIN_WORDS = 100
MIN_DISTINCT_PER_CENT = 80
MAX_UPPER_PER_CENT = 10
SYMBOLS = b"#$%&*|"

_FLAGS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()),
                    ("digest", pa.binary())])
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_AUDIT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                    *[(c, pa.int64()) for c in _COUNTS]])
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1  # A-Z
_CLASS[0x80:0xC0] = 2  # continuation bytes of UTF-8


def text_mask(text: bytes) -> int:
    """Bits of the filters A-D that a text fails."""
    words = text.split()  # of bytes: at 0x20 and 0x09-0x0D
    kind = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=3)
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PER_CENT * len(words)) << 1
            | int(100 * kind[1] > MAX_UPPER_PER_CENT * (len(text) - kind[2])) << 2
            | any(s in text for s in SYMBOLS) << 3)


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_slices(batch, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(map(text_mask, texts), pa.int32()),
                 pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts],
                          pa.binary())], schema=_FLAGS)


def selectors() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(orders, which filter each step applies, selectors of removed, of kept), a
    selector holding a pair of weights for each filter's axis."""
    passes, fails, both = (1, 0), (0, 1), (1, 1)
    orders = ["".join(o) for o in permutations(FILTERS)]
    at, removed, kept = [], [], []
    for order in orders:
        for step, letter in enumerate(order):
            before = order[:step]
            at.append(FILTERS.index(letter))
            removed.append([passes if f in before else fails if f == letter else both
                            for f in FILTERS])
            kept.append([passes if f in order[:step + 1] else both for f in FILTERS])
    return orders, np.array(at), np.array(removed, np.int64), np.array(kept, np.int64)


def contract(tensor: np.ndarray, selector: np.ndarray) -> np.ndarray:
    """Counts (part, kind, selector) of tensors (part, kind, 2, 2, 2, 2, 2)."""
    axes = [np.ascontiguousarray(selector[:, i]) for i in range(len(FILTERS))]
    return np.einsum("pkabcde,sa,sb,sc,sd,se->pks", tensor, *axes, optimize=True)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders, at, removed, kept = selectors()
    eye = np.eye(len(FILTERS), dtype=np.int64)
    fails = np.stack([1 - eye, np.ones_like(eye)], axis=2)  # the filter's axis fails, others all
    alone = np.stack([1 - eye, eye], axis=2)  # the filter's axis fails, others pass
    names = np.repeat(orders, len(FILTERS))
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders))
    for batch in batches:
        for i, row in enumerate(batch.column("cells").to_pylist()):
            cells = np.zeros((1, 3, 2 ** len(FILTERS)), np.int64)
            for c in row:
                cells[0, :, c["mask"]] = c["n"], c["good"], c["toxic"]
            # Bit i of the mask is filter i, the tensor's axis i: reversed bits in C order.
            tensor = cells.reshape(1, 3, *[2] * len(FILTERS)).transpose(0, 1, 6, 5, 4, 3, 2)
            gone = contract(tensor, removed)[0]
            stay = contract(tensor, kept)[0, 0]
            total = contract(tensor, fails)[0, 0][at]
            only = contract(tensor, alone)[0, 0][at]
            share = np.zeros(len(FILTERS), np.int64)
            np.add.at(share, at, gone[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("part")[i].as_py()] * len(names), pa.string()),
                 pa.array(names.tolist(), pa.string()), pa.array(steps),
                 *map(pa.array, (stay, gone[0], total - gone[0], only, gone[1], gone[2],
                                 share[at]))], schema=_AUDIT)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (``lang``, null as empty), order of the five filters and step: counts
    of documents kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null texts count as empty.  A text of any length is read whole, one at a time.
    Rows that share a ``doc_id`` count apart and none is a copy of the other; a row
    with a null id is nobody's copy and has no labels.  Of several labels of one id
    the highest counts, null as 0.  Other columns are not looked at.  An empty table
    gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "filter-audit")
    flags = scratch.write(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("binary").alias("text"),
    ).mapInArrow(_flags, "doc_id long, part string, mask int, digest binary"), "flags")
    first = (flags.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .select("digest", "doc_id", F.lit(True).alias("first")))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    marked = flags.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    cells = marked.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    # At most 32 cells a part.
    tensors = cells.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return tensors.mapInArrow(
        _audit, "part string, filter_order string, step int, "
        + ", ".join(f"{c} long" for c in _COUNTS))
