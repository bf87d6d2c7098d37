"""Token sequences by shortest-pack-first over the length histogram (operator 4).

A document's ids are cut into whole sequences and one rest.  The rests' length
histogram (fewer rows than a sequence has ids) is packed on the driver, longest
first: so many rests of a length join the packs with the most room that still
hold them, which splits a pattern's count rather than visiting documents.  The
result is a table of patterns with counts.  Patterns that stay far from full
are then dissolved: their rests, cut where a gap ends, fill the gaps of the
others, so all but a few sequences are full up to small gaps.

Documents find their pattern by rank among the rests of equal length.  Ranks
are counted within (table part, length) and shifted by the counts of earlier
parts, so a length that a third of all documents share is not one group, and
the ids are shuffled once.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, text_slices

LENGTH = 2048
END_ID = 1
#: Gaps below this many ids are left as padding rather than filled with slivers.
LEAST_GAP = 32
#: Texts that each process encodes both ways.
COMPARE = 20

#: Characters on whose classes all versions of Unicode agree.
_COMMON = re.compile("[\t-\r\x20-\x7e\xc0-\u024f]*")
_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_PIECE_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, ids binary")


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file, without the special tokens that it
    would add; the string of a special token in a text gets that token's id.

    ``ranks_path`` may name the same vocabulary as ranks (with its ``pattern``):
    texts of ASCII and Latin letters are then encoded by ``tiktoken``, which gives
    the same ids about four times faster; texts that hold an added token's string
    are not among them.  Each process compares the two on its first texts, and any
    difference is an error.
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = "<u4" if self.wide else "<u2"
        self.code = "I" if self.wide else "H"
        self.quick = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                           special_tokens={}).encode_ordinary
        self.to_compare = COMPARE

    def _exact(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.quick is None:
            return self._exact(texts)
        out = [array(self.code, self.quick(t)).tobytes()
               if _COMMON.fullmatch(t) and not self.added.search(t) else None for t in texts]
        rare = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rare, self._exact([texts[i] for i in rare])):
            out[i] = ids
        if self.to_compare > 0:
            some = texts[:self.to_compare]
            self.to_compare -= len(some)
            if out[:len(some)] != self._exact(some):
                raise ValueError("ranks_path does not hold the vocabulary of the tokenizer")
        return out


_encoders: dict[str, Encoder] = {}


def _encoded(path: str, end_id: int | None, ranks: tuple[str, str] | None):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                        ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path, *(ranks or ()))
        enc = _encoders[path]
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                ids = [i + end for i in enc.encode([t.decode("utf-8", "replace")
                                                    for t in texts])]
                size = 4 if enc.wide else 2
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("row")),
                     part.column(part.schema.get_field_index("doc_id")),
                     pa.array([len(i) // size for i in ids], pa.int64()),
                     pa.array(ids, pa.binary())], schema=schema)
    return run


def shortest_pack_first(histogram: dict[int, int], capacity: int
                        ) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, number of such packs); every length is placed."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # free ids -> patterns
    free: list[int] = []  # keys of room, ascending

    def put(space: int, pattern: tuple[int, ...], count: int) -> None:
        if space not in room:
            room[space] = []
            free.insert(bisect_right(free, space), space)
        room[space].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not free or free[-1] < length:
                # Open packs, each taking as many of this length as fit.
                each = min(capacity // length, left)
                put(capacity - each * length, (length,) * each, left // each)
                left -= left // each * each
                continue
            space = free[-1]  # the shortest packs
            pattern, count = room[space].pop()
            if not room[space]:
                del room[space]
                free.pop()
            each = min(space // length, left)
            packs = min(count, left // each)
            if packs < count:
                put(space, pattern, count - packs)
            put(space - each * length, pattern + (length,) * each, packs)
            left -= packs * each
    return [(p, c) for patterns in room.values() for p, c in patterns]


@dataclass
class Plan:
    """Where the rests go: bounded tables, looked up by (length, rank)."""

    capacity: int
    sequences: int = 0
    #: length -> (first ranks, slots); a slot is (pattern, offset of the first of a run,
    #: rests of this length in a pack, first rank)
    slots: dict[int, tuple[list[int], list[tuple[int, int, int, int]]]] = field(
        default_factory=dict)
    first_sequence: list[int] = field(default_factory=list)  # of each pattern
    fill: list[int] = field(default_factory=list)
    stream: list[int] = field(default_factory=list)  # a dissolved pattern's place, else -1
    gaps: list[tuple[int, int, int, int]] = field(default_factory=list)
    gap_starts: list[int] = field(default_factory=list)

    def pieces(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the rest, length, sequence, offset) of a rest's pieces."""
        starts, slots = self.slots[length]
        pattern, offset, each, first = slots[bisect_right(starts, rank) - 1]
        pack, nth = divmod(rank - first, each)
        offset += nth * length
        if self.stream[pattern] < 0:
            yield 0, length, self.first_sequence[pattern] + pack, offset
            return
        at = self.stream[pattern] + pack * self.fill[pattern] + offset
        done = 0
        while done < length:
            begin, gap, sequence, fill = self.gaps[bisect_right(self.gap_starts, at) - 1]
            nth, inside = divmod(at - begin, gap)
            take = min(gap - inside, length - done)
            yield done, take, sequence + nth, fill + inside
            done += take
            at += take


def make_plan(histogram: dict[int, int], capacity: int, least_gap: int = LEAST_GAP) -> Plan:
    plan = Plan(capacity)
    patterns = sorted(((sum(p), p, c) for p, c in shortest_pack_first(histogram, capacity)),
                      reverse=True)
    # Dissolve the least filled patterns as long as the others' gaps take their ids.
    gaps = [(capacity - s) if capacity - s >= least_gap else 0 for s, _, _ in patterns]
    space = sum(g * c for g, (_, _, c) in zip(gaps, patterns))
    keep, moved, split = len(patterns), 0, None
    while keep:
        s, p, c = patterns[keep - 1]
        g = gaps[keep - 1]
        if not g:
            break
        # n packs of this pattern move into what is left of the gaps without theirs
        n = min(c, max(0, (space - moved) // (s + g)))
        moved += n * s
        space -= n * g
        if n < c:
            split = n
            break
        keep -= 1
    kept = patterns[:keep]
    gone = patterns[keep:]
    if keep and split:
        s, p, c = kept.pop()
        kept.append((s, p, c - split))
        gone.insert(0, (s, p, split))
    at = 0
    for s, p, c in kept:
        plan.first_sequence.append(plan.sequences)
        if capacity - s >= least_gap and gone:
            plan.gaps.append((at, capacity - s, plan.sequences, s))
            at += (capacity - s) * c
        plan.sequences += c
        plan.fill.append(s)
        plan.stream.append(-1)
    plan.gap_starts = [g[0] for g in plan.gaps]
    at = 0
    for s, p, c in gone:
        plan.first_sequence.append(-1)
        plan.fill.append(s)
        plan.stream.append(at)
        at += s * c
    next_rank: dict[int, int] = {}
    for i, (_, p, c) in enumerate([*kept, *gone]):
        offset, j = 0, 0
        while j < len(p):
            each = 1
            while j + each < len(p) and p[j + each] == p[j]:
                each += 1
            starts, slots = plan.slots.setdefault(p[j], ([], []))
            first = next_rank.get(p[j], 0)
            starts.append(first)
            slots.append((i, offset, each, first))
            next_rank[p[j]] = first + c * each
            offset += p[j] * each
            j += each
    return plan


def _cut(plan: Plan, wide: bool, with_ids: bool):
    dtype = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = plan.capacity
        for batch in batches:
            out: list[tuple] = []
            cols = [batch.column(batch.schema.get_field_index(c))
                    for c in ("doc_id", "n", "ids", "rank", "whole")]
            for doc_id, n, ids, rank, whole in zip(*(c.to_pylist() for c in cols)):
                data = np.frombuffer(ids, dtype).astype("<u4")
                places = [(k * size, size, plan.sequences + whole + k, 0)
                          for k in range(n // size)]
                rest = n % size
                if rest:
                    places += [(n - rest + a, take, seq, at)
                               for a, take, seq, at in plan.pieces(rest, rank)]
                for start, take, seq, at in places:
                    b = data[start:start + take].tobytes()
                    out.append((doc_id, start, take, zlib.crc32(b), n, seq, at,
                                b if with_ids else None))
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), _PIECE)], schema=_PIECE)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _PIECE)], schema=_PIECE)
    return run


def pack_sequences(docs: DataFrame, tokenizer_path: str, *,
                   ranks: tuple[str, str] | None = None, length: int = LENGTH,
                   end_id: int | None = END_ID, least_gap: int = LEAST_GAP,
                   with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and, with ``with_ids``, ids (little-endian unsigned 32-bit).

    Every row of ``docs`` is packed, repeated ones as often as they occur; a null
    text is empty (its only id is ``end_id``; without one it has no piece).
    Sequences hold at most ``length`` ids, gapless from offset 0.  ``ranks`` is the
    (path, pattern) of the same vocabulary for a quicker encoder, see Encoder.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    base = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    tokens = scratch.write(base.mapInArrow(_encoded(tokenizer_path, end_id, ranks),
                                           "row long, doc_id long, n long, ids binary"), "tokens")
    keyed = tokens.withColumns({"part": F.shiftright("row", 33), "rest": F.col("n") % length,
                                "full": F.floor(F.col("n") / length).cast("long")})
    # Counts of (part, length): at most parts * length narrow rows.
    cells = scratch.write(keyed.groupBy("part", "rest").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("full").alias("whole")), "cells")
    totals = {r["rest"]: (r["docs"], r["whole"]) for r in cells.groupBy("rest").agg(
        F.sum("docs").alias("docs"), F.sum("whole").alias("whole")).collect()}
    plan = make_plan({r: c for r, (c, _) in totals.items() if r}, length, least_gap)
    before, at = {}, 0  # whole sequences of smaller rests
    for r in sorted(totals):
        before[r] = at
        at += totals[r][1]
    shift = F.element_at(F.from_json(F.lit(str({str(k): v for k, v in before.items()})
                                           .replace("'", '"')), "map<string,bigint>"),
                         F.col("rest").cast("string"))
    earlier = W.partitionBy("rest").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select("part", "rest", F.coalesce(F.sum("docs").over(earlier), F.lit(0))
                           .alias("docs_before"),
                           (F.coalesce(F.sum("whole").over(earlier), F.lit(0)) + shift)
                           .alias("whole_before"))
    here = W.partitionBy("part", "rest").orderBy("row")
    run = here.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (keyed.withColumns({"nth": F.row_number().over(here) - 1,
                                 "sofar": F.sum("full").over(run) - F.col("full")})
              .join(offsets.hint("merge"), ["part", "rest"])
              .select("doc_id", "n", "ids", (F.col("nth") + F.col("docs_before")).alias("rank"),
                      (F.col("sofar") + F.col("whole_before")).alias("whole")))
    from tokenizers import Tokenizer

    wide = Tokenizer.from_file(tokenizer_path).get_vocab_size() > 1 << 16
    out = placed.mapInArrow(_cut(plan, wide, with_ids), _PIECE_DDL)
    return out if with_ids else out.drop("ids")
