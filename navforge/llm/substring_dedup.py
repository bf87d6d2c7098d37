"""Removal of repeated word sequences by difference-cover anchors (operator 2).

A window is ``WINDOW`` consecutive words of one document.  A word goes when a
window over it starts earlier too, in a document with a smaller id or earlier
in the same document.

Hashing every window would shuffle one row per word.  Instead short anchors
are hashed only at word positions p with p mod ``PERIOD`` in ``COVER``.  COVER
is a difference cover: for any two positions i, j some k < PERIOD puts both
i + k and j + k on it, so any two equal windows share an anchor of
WINDOW - PERIOD + 1 words at the same offset.  The steps:

1. anchors, range-partitioned and sorted by hash; those that meet an equal
   neighbour are repeated (about a third of a row per word, one shuffle);
2. the repeated anchors gathered by document and joined with its text; each
   extends to the windows that contain it, hashed to 96 bits, from
   two hashes of each word;
3. the windows, range-partitioned and sorted by (hash, document, start): all
   but the first of each run of equal hashes are repeats.  Range partitions
   split a hash that millions of documents share, and sorted runs are read as
   a stream, so no task holds a group;
4. repeats gathered by document and joined with its text: kept words.

Documents with a null ``doc_id`` come last in the order.  Rows that share a
``doc_id`` are compared by start only (equal windows at the same start do not
remove one another); a null text has no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, emit, longs, release_shuffles, text_slices
from navforge.llm.words import Words

WINDOW = 20
PERIOD = 13
#: Difference cover modulo 13: every residue is a difference of two of these (fixed values).
COVER = (0, 1, 3, 9)

_LAST = (1 << 63) - 1
_ANCHOR = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()),
                     ("pos", pa.int32())])
_POSITION = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("pos", pa.int32())])
_WINDOW = pa.schema([("h", pa.int64()), ("h2", pa.int32()), ("doc", pa.int64()),
                     ("tag", pa.int64()), ("pos", pa.int32())])
_MARK = pa.schema([("kind", pa.int8()), ("part", pa.int32()), ("h", pa.int64()),
                   ("h2", pa.int32()), ("doc", pa.int64()), ("tag", pa.int64()),
                   ("pos", pa.int32())])
_KEPT = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                   ("n_removed", pa.int64()), ("kept", pa.binary())])
_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_sha256", pa.string())])


def _spark_schema(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.int8(): "byte", pa.string(): "string",
             pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def _anchors(window: int, period: int, cover: tuple[int, ...]):
    size = window - period + 1
    on_cover = np.zeros(period, bool)
    on_cover[list(cover)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                w = Words(texts)
                pos = np.arange(len(w.start)) - w.first[:-1][w.doc]
                n = w.count[w.doc]
                at = np.flatnonzero(on_cover[pos % period] & (n >= window) & (pos + size <= n))
                if len(at):
                    d = w.doc[at]
                    yield from emit(_ANCHOR, w.windows(at, size).view(np.int64),
                                    longs(part, "doc")[d], longs(part, "tag")[d],
                                    pos[at].astype(np.int32))
    return run


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition sorted by hash whose hash also stands next to them.
    The first and last row pass unseen: their neighbours may be in the next
    partition, and a needless anchor only costs the hashing of its windows."""
    held: pa.RecordBatch | None = None  # the last row of the batch before
    begin = True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        h = longs(batch, "h")
        same = h[1:] == h[:-1]
        repeat = np.zeros(len(h), bool)
        repeat[1:] |= same
        repeat[:-1] |= same
        if held is not None:
            repeat[0] |= held_repeat
        elif begin:
            repeat[0] = True
        begin = False
        held, held_repeat = batch.slice(len(h) - 1, 1), repeat[-1]
        at = pa.array(np.flatnonzero(repeat[:-1]))
        out = batch.select(["doc", "tag", "pos"]).take(at)
        if out.num_rows:
            yield out
    if held is not None:
        yield held.select(["doc", "tag", "pos"])


def _candidate_windows(window: int, period: int):
    size = window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                w = Words(texts)
                anchors = part.column(part.schema.get_field_index("at"))
                n_at = np.diff(anchors.offsets.to_numpy())
                p = anchors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                d = np.repeat(np.arange(len(texts)), n_at)
                base, n = w.first[:-1][d], w.count[d]
                low = base + np.maximum(p - (window - size), 0)
                high = base + np.minimum(p, n - window) + 1
                ok = high > low
                cover = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(cover, low[ok], 1)
                np.add.at(cover, high[ok], -1)
                at = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
                if len(at):
                    d = w.doc[at]
                    yield from emit(
                        _WINDOW, w.windows(at, window).view(np.int64),
                        (w.windows(at, window, 1) >> np.uint64(32)).astype(np.uint32)
                        .view(np.int32), longs(part, "doc")[d], longs(part, "tag")[d],
                        (at - w.first[:-1][d]).astype(np.int32))
    return run


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks over a partition sorted by (h, h2, doc, pos).

    kind 0: a window that starts earlier too; kind 1: the first place of the
    partition's first run, a repeat only if an earlier partition ends with the
    same hash; kind 2: the partition's last hash.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    first_run = True
    key = place = None  # of the run that is being read
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h, h2, doc, pos = (longs(batch, c) for c in ("h", "h2", "doc", "pos"))
        new = np.ones(n, bool)
        new[1:] = (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])
        carried = key is not None and key == (h[0], h2[0])
        if carried:
            new[0] = False
        elif key is not None:
            first_run = False
        run = np.cumsum(new) - 1  # -1: the carried run
        starts = np.flatnonzero(new)
        f_doc, f_pos = doc[starts], pos[starts]
        if carried:
            f_doc, f_pos, run = np.append(place[0], f_doc), np.append(place[1], f_pos), run + 1
        is_first = (doc == f_doc[run]) & (pos == f_pos[run])
        kind = np.where(is_first, 3, 0).astype(np.int8)
        if first_run:
            kind[(run == 0) & is_first] = 1
        key, place = (h[-1], h2[-1]), (f_doc[run[-1]], f_pos[run[-1]])
        if run[-1] > 0:
            first_run = False
        at = np.flatnonzero(kind < 2)
        if len(at):
            sure = kind[at] == 0  # needs no hash any more
            yield from emit(_MARK, kind[at], np.full(len(at), part, np.int32),
                            pa.array(h[at], mask=sure), pa.array(h2[at], mask=sure),
                            doc[at], longs(batch, "tag")[at], pos[at])
    if key is not None:
        yield from emit(_MARK, [2], [part], [key[0]], [key[1]], [None], [None], [None])


def _kept(window: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            rows = None if digest else longs(batch, "row")
            marks = batch.column(batch.schema.get_field_index("at"))
            texts = batch.column(batch.schema.get_field_index("text"))
            out = []
            for i, doc_id in enumerate(ids):
                words = (texts[i].as_py() or b"").split()  # the same six bytes separate words
                at = marks[i].values
                gone = 0
                if at is not None and len(at):
                    cover = np.zeros(len(words) + 1, np.int64)
                    start = np.asarray(at.to_numpy(zero_copy_only=False))
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + window, -1)
                    keep = np.cumsum(cover)[:-1] == 0
                    gone = int(len(words) - keep.sum())
                    words_kept = [words[j] for j in np.flatnonzero(keep)]
                else:
                    words_kept = words
                text = b" ".join(words_kept)
                out.append((doc_id, len(words), gone, hashlib.sha256(text).hexdigest())
                           if digest else (int(rows[i]), doc_id, len(words), gone, text))
            if out:
                yield from emit(_DIGEST if digest else _KEPT, *map(list, zip(*out)))
    return run


def substring_dedup(docs: DataFrame, *, window: int = WINDOW, period: int = PERIOD,
                    cover: tuple[int, ...] = COVER, digest: bool = False) -> DataFrame:
    """Documents (``doc_id``, ``text``) without the words of repeated windows.

    Returns doc_id, n_words, n_removed and, with ``digest``, kept_sha256 (of the
    kept words joined by one space); else ``kept_text`` beside all columns of
    the input.  ``period`` must leave anchors of at least one word.
    """
    if not 0 < period <= window:
        raise ValueError("period must be from 1 to the window's number of words")
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover is not a difference cover of period")
    spark = docs.sparkSession
    scratch = Scratch(spark, "substring-dedup")
    # A tag tells rows with one doc_id apart; where ids are unique it is constant.
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"))
    repeated = not ids.groupBy("doc").count().filter("count > 1").isEmpty()
    tag = F.xxhash64(F.col("text")) if repeated else F.lit(0).cast("long")
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"),
                       tag.alias("tag"), F.col("text").cast("binary").alias("text"))

    anchors = base.mapInArrow(_anchors(window, period, cover), _spark_schema(_ANCHOR))
    found = (anchors.repartitionByRange("h", "doc", "pos").sortWithinPartitions("h")
             .mapInArrow(_repeated_anchors, _spark_schema(_POSITION))
             .groupBy("doc", "tag").agg(F.collect_set("pos").alias("at")))
    found = scratch.write(found, "anchors")
    del anchors
    release_shuffles(spark)

    marks = (base.join(found, ["doc", "tag"])
             .mapInArrow(_candidate_windows(window, period), _spark_schema(_WINDOW))
             .repartitionByRange("h", "h2", "doc", "pos")
             .sortWithinPartitions("h", "h2", "doc", "pos")
             .mapInArrow(_repeats, _spark_schema(_MARK)))
    marks = scratch.write(marks, "marks")
    scratch.drop("anchors")
    release_shuffles(spark)

    # One row per partition decides for the runs that partitions cut.
    last = marks.filter("kind = 2").select("h", "h2", F.col("part").alias("before"))
    cut = (marks.filter("kind = 1").join(last, ["h", "h2"])
           .filter("before < part").select("doc", "tag", "pos").distinct())
    at = (marks.filter("kind = 0").select("doc", "tag", "pos").unionByName(cut)
          .groupBy("doc", "tag").agg(F.collect_set("pos").alias("at")))
    if digest:
        text = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"),
                           tag.alias("tag"), F.col("text").cast("binary").alias("text"))
        return (text.join(at, ["doc", "tag"], "left").select("doc_id", "text", "at")
                .mapInArrow(_kept(window, True), _spark_schema(_DIGEST)))
    rows = scratch.write(docs.withColumn("__row", F.monotonically_increasing_id())
                         .withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"),
                                                         F.lit(_LAST)))
                         .withColumn("__tag", tag), "rows")
    kept = (rows.select(F.col("__row").alias("row"), F.col("doc_id").cast("long")
                        .alias("doc_id"), F.col("text").cast("binary").alias("text"),
                        F.col("__doc").alias("doc"), F.col("__tag").alias("tag"))
            .join(at, ["doc", "tag"], "left").select("row", "doc_id", "text", "at")
            .mapInArrow(_kept(window, False), _spark_schema(_KEPT))
            .select(F.col("row").alias("__row"), F.col("n_words").alias("__n_words"),
                    F.col("n_removed").alias("__n_removed"),
                    F.col("kept").cast("string").alias("__kept")))
    return (rows.drop("n_words", "n_removed", "kept_text").join(kept, "__row")
            .withColumnsRenamed({"__n_words": "n_words", "__n_removed": "n_removed",
                                 "__kept": "kept_text"})
            .drop("__row", "__doc", "__tag"))
