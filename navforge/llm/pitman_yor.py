"""Hierarchical Pitman-Yor language model (operator 11).

Every word that precedes a token is a context with a restaurant of its own; all
these restaurants share one parent, the restaurant of single words, whose own
base is uniform over the training words and one unknown word.  The customers of a
context are the tokens after it; a customer sits down at a table of its word or
opens one, and every table sends one customer to the parent.  Gibbs sampling
redraws the tables, and the probability of a token is the average of the
predictive probabilities over the last sweeps.

How it is spread over a cluster.  All tables are narrow rows that carry packed
arrays, grouped by one key at a time:

1. *Blocks*: the texts, read once, as word numbers of blocks of about a million
   tokens, each with its own word list.
2. *Vocabulary shards*: block word lists dealt out by the words' checksums; a shard
   counts its words exactly, numbers them and answers each block.
3. *Buckets*: each block's distinct (context, word) pairs with counts, dealt out by
   context; a context with many tokens is split over several buckets by word, in
   proportion to its tokens.  A bucket merges its blocks' pairs.
4. *Sweeps*: a sweep redraws all tables of all contexts, then those of the parent.
   Buckets send the tables of their words to the parent's ranges of words, and
   those answer with the words' customers and tables.  Within a sweep the other
   side's numbers are those of the sweep before: the usual approximation of Gibbs
   sampling in parallel.
5. *Scores*: buckets answer blocks with the averaged log probability of each of
   their pairs, seen in training or not, and a block adds them up by document.

The tables of one word in one restaurant are redrawn together, from their
conditional distribution given all others.  Up to EXACT customers that distribution
is tabled by generalised Stirling numbers.  Beyond, candidates come from seating the
customers one after the other, and one is picked by importance weights; seating
jumps from one new table to the next, so the work goes with the number of tables,
and past MANY customers in steps.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import SLICE_BYTES, Scratch
from navforge.llm.minhash_dedup import sorted_groups
from navforge.llm.words import mix

#: Tokens of a block, and bytes after which a long text goes on in the next one.
BLOCK_TOKENS = 1 << 20
BLOCK_BYTES = 1 << 22
#: Entries of a vocabulary shard, of a bucket and of a range of the parent, on average.
SHARD = 1 << 20
#: Training tokens of a context in one bucket.
SPLIT = 1 << 18
#: Sweeps, how many of the last ones are averaged, candidates for each redrawn word.
SWEEPS = 4
SAMPLES = 2
CANDIDATES = 8
#: Concentration of both levels.
THETA = 1.0
#: Customers up to which the distribution of the tables is tabled.
EXACT = 250
#: Customers from which seating goes on in steps of a 256th of those seated.
MANY = 1 << 14

UNKNOWN, END = 0, 1  # ids; other words from 2 on
_END = b"\n"  # the end token in word lists; no word holds white space
_SPACE = re.compile(rb"[ \t-\r]")
# Rows between keys: a to f are packed arrays or word lists.
_BLOBS = "abcdef"
_MAIL = ("dest long, kind int, src long, total long, x long, y long, "
         + ", ".join(f"{c} binary" for c in _BLOBS))
_MAIL_ARROW = pa.schema([("dest", pa.int64()), ("kind", pa.int32()), ("src", pa.int64()),
                         ("total", pa.int64()), ("x", pa.int64()), ("y", pa.int64()),
                         *[(c, pa.binary()) for c in _BLOBS]])
_SCORES = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                     ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])
# Kinds of rows.
(BLOCK, WORDS, PAIRS, PLACES, REPEATED, ALL_WORDS, SEATS, ANSWER, CONTEXT, PARENT,
 SCORES) = range(11)


# ---------------------------------------------------------------------------
# Packed arrays and rows
# ---------------------------------------------------------------------------
_zip, _unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(a: np.ndarray) -> bytes:
    """Integers as compressed byte planes, as many as the largest needs."""
    a = np.ascontiguousarray(a, np.int64).view("<u8")
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    planes = np.empty((width, len(a)), np.uint8)
    for i in range(width):
        planes[i] = (a >> 8 * i).astype(np.uint8)
    return bytes([width]) + _zip.compress(planes)


def unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(_unzip.decompress(b[1:]), np.uint8).reshape(b[0], -1)
    out = planes[0].astype(np.int64)
    for i in range(1, len(planes)):
        out |= planes[i].astype(np.int64) << 8 * i
    return out


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=0))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b))


def ranked(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers (none negative) in order, where each comes first, and the
    rank of each entry: by one sort of numbers that carry their places, where both fit."""
    bits = len(a).bit_length()
    if not len(a) or int(a.max()).bit_length() + bits > 63:
        return np.unique(a, return_index=True, return_inverse=True)
    s = np.sort(a << bits | np.arange(len(a)))
    at = s & (1 << bits) - 1
    s >>= bits
    new = np.append(True, s[1:] != s[:-1])
    rank = np.empty(len(a), np.int64)
    rank[at] = np.cumsum(new) - 1
    return s[new], at[new], rank


def row(dest: int, kind: int, src: int = 0, total: int = 0, x: int = 0, y: int = 0,
        **blobs: bytes) -> pa.RecordBatch:
    values = [dest, kind, src, total, x, y, *map(blobs.get, _BLOBS)]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(values, _MAIL_ARROW)], schema=_MAIL_ARROW)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[dict]]]]:
    """(key, its rows by kind), the rows of a kind in order of ``src``."""
    for g in sorted_groups(batches, ["dest"]):
        kinds: dict[int, list[dict]] = defaultdict(list)
        for r in g.to_pylist():
            kinds[r["kind"]].append(r)
        yield g.column(0)[0].as_py(), kinds


def gathered(mail: DataFrame, task) -> DataFrame:
    return (mail.repartition("dest").sortWithinPartitions("dest", "kind", "src")
            .mapInArrow(task, _MAIL))


# ---------------------------------------------------------------------------
# 1. Blocks
# ---------------------------------------------------------------------------
def cut(text: bytes, size: int) -> Iterator[tuple[bytes, bool]]:
    """(part, whether it is the last) of a text, cut at white space after ``size`` bytes."""
    at = 0
    while len(text) - at > size:
        space = _SPACE.search(text, at + size)
        if space is None:
            break
        yield text[at:space.start()], False
        at = space.start()
    yield text[at:] if at else text, True


def checksums(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def split_words(data: bytes, only_spaces: bool = False
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the words one after the other, where each word begins in ``data``,
    and their lengths."""
    a = np.frombuffer(data, np.uint8)
    inside = a != 0x20
    if not only_spaces:
        inside &= a - np.uint8(9) > 4  # wraps below 9
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return a[inside], edges[::2], edges[1::2] - edges[::2]


def word_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(lengths))
    return pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def joined(words: pa.Array) -> bytes:
    """Words with a space between them."""
    offsets, data = (np.frombuffer(b, t) if b else np.empty(0, t)
                     for b, t in zip(words.buffers()[1:], (np.int64, np.uint8)))
    edges = offsets[words.offset:words.offset + len(words) + 1]
    out = np.full(edges[-1] - edges[0] + len(words), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[edges[1:] - edges[0] + np.arange(len(words))] = False
    out[inside] = data[edges[0]:edges[-1]]
    return out[:-1].tobytes()


def numbered(lists: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of some arrays, and the number of each entry."""
    chunks = pa.chunked_array(lists, pa.large_binary()).dictionary_encode().chunks
    return chunks[-1].dictionary, np.concatenate(
        [c.indices.to_numpy(zero_copy_only=False) for c in chunks]).astype(np.int64)


class _Block:
    """Texts of a block: arrays of words, in which an empty one is the end token, and
    their pieces with the word before each."""

    def __init__(self, number: int):
        self.number = number
        self.words: list[pa.Array] = []
        self.pieces: list[tuple] = []
        self.leads: list[bytes] = []
        self.size = 0

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The tokens, and the word list in order of checksums, and so in order of any
        number of shards."""
        distinct, codes = numbered([*self.words, pa.array(self.leads, pa.large_binary())])
        words = [w or _END for w in joined(distinct).split(b" ")]
        order = np.argsort(checksums(words), kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        codes, leads = np.split(place[codes], [self.size])
        pieces = np.array([*zip(*self.pieces), leads], np.int64)
        learned = np.repeat(pieces[3] == 0, pieces[4])
        yield row(self.number, BLOCK, total=len(codes), a=pack(codes), b=pack(pieces.ravel()))
        yield row(self.number, WORDS, x=len(words), a=b" ".join([words[i] for i in order.tolist()]),
                  b=pack(np.bincount(codes[learned], minlength=len(words))))


def _pieces(batches: Iterator[pa.RecordBatch], uid: int, size: int) -> Iterator[list[tuple]]:
    """(uid, doc_id, held, part, whether it is the last) of all texts, some MB at a time."""
    some, length = [], 0
    for batch in batches:
        for doc_id, held, text in zip(*(batch.column(i) for i in range(3))):
            uid += 1
            for part, last in cut(text.as_py() or b"", size):
                some.append((uid, doc_id.as_py(), held.as_py(), part, last))
                length += len(part)
                if length >= SLICE_BYTES:
                    yield some
                    some, length = [], 0
    if some:
        yield some


def _blocks(tokens: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        number, before, lead = place << 32, None, b""
        block = _Block(number)
        for some in _pieces(batches, place << 36, size):
            # Of bytes: A-Z, and at 0x20, 0x09-0x0D.
            data, begin, lengths = split_words(b" ".join([p[3] for p in some]).lower())
            stop = np.searchsorted(begin, np.cumsum([len(p[3]) + 1 for p in some]))
            last = np.array([p[4] for p in some])
            words = word_array(data, np.insert(lengths, stop[last], 0))
            stop += np.cumsum(last)
            at = start = 0
            for (uid, doc_id, held, _, _), end in zip(some, stop.tolist()):
                if uid != before:
                    before, lead = uid, b""
                if end > at:
                    block.pieces.append((uid, doc_id or 0, doc_id is not None, held, end - at))
                    block.leads.append(lead)
                    block.size += end - at
                    at, lead = end, words[end - 1].as_py()
                if block.size >= tokens:
                    block.words.append(words[start:at])
                    yield from block.rows()
                    number, start = number + 1, at
                    block = _Block(number)
            block.words.append(words[start:at])
        if block.size:
            yield from block.rows()
    return run


# ---------------------------------------------------------------------------
# 2. Vocabulary
# ---------------------------------------------------------------------------
def _to_shards(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words, count = r["a"].split(b" "), unpack(r["b"])
                shard = checksums(words) * np.uint64(shards) >> np.uint64(32)
                edges = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(words)]
                for i, j in zip(edges[:-1], edges[1:]):
                    yield row(int(shard[i]), WORDS, r["dest"], a=b" ".join(words[i:j]),
                              b=pack(count[i:j]))
    return run


def _count_words(shards: int):
    """Answers blocks with ids and counts; the first row has the shard's known words and tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, kinds in groups(batches):
            rows = kinds[WORDS]
            lists = [word_array(*split_words(r["a"], only_spaces=True)[::2]) for r in rows]
            words, codes = numbered(lists)
            total = np.bincount(codes, np.concatenate([unpack(r["b"]) for r in rows]),
                                len(words)).astype(np.int64)
            end = pc.equal(words, pa.scalar(_END, words.type)).to_numpy(zero_copy_only=False)
            order = pc.array_sort_indices(words).to_numpy().astype(np.int64)
            order = order[((total > 0) & ~end)[order]]
            order = order[np.argsort(-total[order], kind="stable")]
            ids = np.where(end & (total > 0), END, UNKNOWN)
            ids[order] = 2 + np.arange(len(order)) * shards + shard
            tokens, size = int(total.sum()), int((ids != UNKNOWN).sum())
            for r, at in zip(rows, np.split(codes, np.cumsum([len(x) for x in lists])[:-1])):
                yield row(r["src"], WORDS, shard, total=tokens, x=size, a=pack(ids[at]),
                          b=pack(total[at]))
                tokens = size = 0
    return run


# ---------------------------------------------------------------------------
# 3. Pairs
# ---------------------------------------------------------------------------
class _Tokens:
    """A block's tokens with the vocabulary's answers, and its distinct pairs in the
    order of their buckets, then contexts, then words."""

    def __init__(self, block: dict, answers: list[dict], buckets: int, split: int):
        codes = unpack(block["a"])
        ids = np.concatenate([unpack(r["a"]) for r in answers])
        count = np.concatenate([unpack(r["b"]) for r in answers])
        self.uid, self.doc_id, self.has_id, held, self.n, lead = unpack(block["b"]).reshape(6, -1)
        self.count = count[codes]
        self.held = held.astype(bool)
        self.first = np.cumsum(self.n) - self.n
        before = np.empty_like(codes)
        before[1:] = codes[:-1]
        before[self.first] = lead
        ids, at, number = ranked(ids)
        key, _, inverse = ranked(number[before] * len(ids) + number[codes])
        at_u, at_w = np.divmod(key, len(ids))
        u, w, size = ids[at_u], ids[at_w], np.where(ids == UNKNOWN, 0, count[at])[at_u]
        n = np.bincount(inverse, np.repeat(held == 0, self.n), len(key)).astype(np.int64)
        # A context's tokens lie in 1 + size // split buckets; pairs of the unknown one anywhere.
        parts = (1 + size // split).view(np.uint64)
        spread = mix(w.view(np.uint64)) >> np.uint64(1)
        sub = np.where(u == UNKNOWN, spread, spread % parts)
        bucket = mix(mix(u.view(np.uint64)) ^ sub) % np.uint64(buckets)
        if buckets <= 1 << 16:
            bucket = bucket.astype(np.uint16)  # sorted by radix
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.u, self.w, self.pair_n = u[order], w[order], n[order]
        self.bucket, self.size = bucket[order].astype(np.int64), size[order]
        self.split, self.pair = (parts > 1)[order], place[inverse]
        self.edges = np.append(np.flatnonzero(np.diff(self.bucket, prepend=-1)), len(order))


def _to_buckets(buckets: int, split: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, kinds in groups(batches):
            t = _Tokens(kinds[BLOCK][0], kinds[WORDS], buckets, split)
            for i, j in zip(t.edges[:-1], t.edges[1:]):
                large, at = np.unique(t.u[i:j][t.split[i:j]], return_index=True)
                sizes = t.size[i:j][t.split[i:j]][at]
                yield row(int(t.bucket[i]), PAIRS, number, a=pack_sorted(t.u[i:j]),
                          b=pack(t.w[i:j]), c=pack(t.pair_n[i:j]),
                          d=pack(np.concatenate([large, sizes])))
    return run


def by_range(words: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ``words`` in order of the parent's ranges, and where each range begins and ends."""
    words = words[np.argsort(words % ranges, kind="stable")]
    return words, np.append(np.flatnonzero(np.diff(words % ranges, prepend=-1)), len(words))


def _merge_pairs(ranges: int):
    """For each bucket a row of all its pairs (x, y: those of one and of two tokens) and
    one of what the sweeps need of those of two tokens and more; for the parent's ranges
    the bucket's words with the number of their pairs of one token, which always have one
    table; for each block the places of its pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, kinds in groups(batches):
            rows = kinds[PAIRS]
            us = [unpack_sorted(r["a"]) for r in rows]
            contexts, _, at_u = ranked(np.concatenate(us))
            ids, _, at_w = ranked(np.concatenate([unpack(r["b"]) for r in rows]))
            key, _, inverse = ranked(at_u * len(ids) + at_w)
            at_u, at_w = np.divmod(key, len(ids))
            n = np.bincount(inverse, np.concatenate([unpack(r["c"]) for r in rows]),
                            len(key)).astype(np.int64)
            large = np.concatenate([unpack(r["d"]).reshape(2, -1) for r in rows], axis=1)
            large = large[:, np.unique(large[0], return_index=True)[1]]
            size = np.bincount(at_u, n, len(contexts)).astype(np.int64)
            size[np.searchsorted(contexts, large[0])] = large[1]
            words, edges = by_range(ids[ids != UNKNOWN], ranges)
            place = np.full(len(ids), len(words))  # of the unknown word: after all others
            place[np.searchsorted(ids, words)] = np.arange(len(words))
            word = place[at_w]
            single = n == 1
            yield row(bucket, PAIRS, x=int(single.sum()), y=int((n == 2).sum()),
                      a=pack(np.bincount(at_u, minlength=len(contexts))), b=pack(size),
                      c=pack(n), d=pack(word), e=pack_sorted(contexts), f=pack(words))
            ones = np.bincount(word[single], minlength=len(words) + 1)
            for i, j in zip(edges[:-1], edges[1:]):
                yield row(int(words[i] % ranges), ALL_WORDS, bucket,
                          a=pack_sorted(words[i:j]), b=pack(ones[i:j]))

            more = n > 1
            keep = np.bincount(at_u[more], minlength=len(contexts))
            some = (keep > 0) | np.isin(contexts, large[0])
            used = np.unique(word[more])  # training pairs hold no unknown word
            yield row(bucket, REPEATED, a=pack(keep[some]), b=pack(np.bincount(
                at_u[single], minlength=len(contexts))[some]), c=pack(n[more]),
                d=pack(np.searchsorted(used, word[more])), e=pack_sorted(contexts[some]),
                f=pack(np.concatenate([words[used], large[0]])), x=len(used))
            at = 0
            for r, own in zip(rows, us):
                yield row(bucket, PLACES, r["src"], a=pack(inverse[at:at + len(own)]))
                at += len(own)
    return run


# ---------------------------------------------------------------------------
# 4. Seating
# ---------------------------------------------------------------------------
def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0 (Stirling's series from 7 on)."""
    shift = np.ones_like(x)
    for i in range(7):
        shift *= x + i
    y = x + 7
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - np.log(shift)


@lru_cache(maxsize=4)
def log_stirling(d: float, most: int) -> np.ndarray:
    """log of the generalised Stirling numbers: [c, t] weighs all seatings of c
    customers at t tables, each by the product of (1 - d)(2 - d)... over its tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    if most:
        out[1, 1] = 0
    for c in range(1, most):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            stay = np.log(np.maximum(c - d * t, 0)) + out[c, 1:c + 2]
        out[c + 1, 1:c + 2] = np.logaddexp(out[c, :c + 1], stay)
    return out


def add_up(a: np.ndarray) -> None:
    """Running sums down the columns, in place."""
    if len(a) > a.shape[1]:
        np.cumsum(a, axis=0, out=a)
    else:
        for i in range(1, len(a)):
            a[i] += a[i - 1]


def _by_table(c, others, q, theta, d, rng) -> np.ndarray:
    """Tables of words with 2 to EXACT customers, from their exact distribution."""
    t = np.ones(len(c))
    if not len(c):
        return t
    ways = log_stirling(d, EXACT)
    order = np.argsort(c.astype(np.uint16), kind="stable")  # sorted by radix
    for at in np.split(order, np.flatnonzero(np.diff(c[order])) + 1):
        n = int(c[at[0]])
        k = np.arange(1, n)[:, None]
        for some in np.array_split(at, -(-len(at) * n // (1 << 20))):
            p = np.zeros((n, len(some)))  # a column for each word
            np.log((theta + d * (others[some] + k)) * q[some], out=p[1:])
            add_up(p)
            p += ways[n, 1:n + 1, None]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            add_up(p)
            t[some] = 1 + (p < rng.random(len(some)) * p[-1]).sum(axis=0)
    return t


def _next_table(m, k, top, e, a, h, start, draw, d) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to the next new table: customers then seated, whether it opened, log weight."""
    with np.errstate(over="ignore"):
        at = top * ((draw + start) / h) ** (1 / e)
    seen = np.clip(np.ceil(at) - 1, m, top)  # customers who sit when the table opens
    opened, end = seen < top, np.minimum(seen + 1, top)
    stop = h * (seen / top) ** e
    gap = np.where(opened, h * (end / top) ** e - stop, 1.0)
    weight = log_gamma(seen - d * k) - log_gamma(m - d * k) + stop - start + np.where(
        opened, np.log(a) - np.log(-np.expm1(-np.maximum(gap, 1e-300))), 0)
    return end, opened.astype(np.float64), weight


def _one_by_one(c, others, q, theta, d, rng) -> tuple[np.ndarray, np.ndarray]:
    """(tables, log importance weight) of words whose customers sit down one after the
    other.  The hazard of a new table when n sit is that of the restaurant, a / n, times
    (n / c) ** (d (1 - q)), about what a table more costs the customers still to come;
    its integral is inverted, so that the work goes with the tables."""
    n, t = np.ones(len(c)), np.ones(len(c))
    weight, live = np.zeros(len(c)), np.arange(len(c))
    power = np.maximum(d * (1 - q), 1e-6)
    while len(live):
        m, k, top, e = n[live], t[live], c[live], power[live]
        a = (theta + d * (others[live] + k)) * q[live]  # of a new table
        h = a / e  # the integral of the hazard up to n is h * (n / c) ** e
        start = h * (m / top) ** e
        draw = rng.exponential(size=len(live))
        many = m >= MANY  # steps add no weight: the hazard hardly changes within one
        if many.any():
            end = np.minimum(m + np.floor(m / 256), top)
            new = rng.poisson(np.maximum(h * (end / top) ** e - start, 0))
            new = np.minimum(new, end - m)
            some = np.flatnonzero(~many)
        else:
            end, new, some = np.empty(len(live)), np.empty(len(live)), slice(None)
        if not many.all():
            end[some], new[some], change = _next_table(
                *(x[some] for x in (m, k, top, e, a, h, start, draw)), d)
            weight[live[some]] += change
        n[live], t[live] = end, k + new
        live = live[end < top]
    return t, weight


def seat(c: np.ndarray, others: np.ndarray, q: np.ndarray, theta: float, d: float,
         rng: np.random.Generator, candidates: int = CANDIDATES) -> np.ndarray:
    """Tables of words with ``c`` customers, drawn given the other words' tables.

    Up to EXACT customers the conditional distribution is tabled; beyond, candidates
    come from seating the customers one after the other, and one is picked by its
    importance weight.
    """
    t = np.minimum(c, 1)
    c, others = c.astype(np.float64), others.astype(np.float64)
    few, more = np.flatnonzero((c > 1) & (c <= EXACT)), np.flatnonzero(c > EXACT)
    t[few] = _by_table(c[few], others[few], q[few], theta, d, rng)
    if len(more):
        tables, weight = (x.reshape(candidates, -1) for x in _one_by_one(
            *(np.tile(x[more], candidates) for x in (c, others, q)), theta, d, rng))
        best = np.argmax(weight + rng.gumbel(size=weight.shape), axis=0)
        t[more] = tables[best, np.arange(len(more))]
    return t


def discount(once: int, twice: int) -> float:
    """Discount from the numbers of words with one and with two customers."""
    return min(max(once / (once + 2 * twice), 0.05), 0.95) if once + twice else 0.5


class _Contexts:
    """Contexts of a bucket with their pairs: ``a`` pairs of each context, ``b`` an other
    number of each, ``c`` tokens of each pair, ``d`` places of their words in ``f``."""

    def __init__(self, r: dict):
        pairs, self.extra, self.c = unpack(r["a"]), unpack(r["b"]), unpack(r["c"])
        self.word, self.contexts, self.words = unpack(r["d"]), unpack_sorted(r["e"]), unpack(r["f"])
        self.at = np.repeat(np.arange(len(pairs)), pairs)

    def tables(self, own: np.ndarray, split: list[dict]) -> np.ndarray:
        """Tables of each context, those in other buckets included."""
        for r in split:
            at = np.searchsorted(self.contexts, r["src"])
            if at < len(self.contexts) and self.contexts[at] == r["src"]:
                own[at] = r["total"]
        return own

    def parent(self, answers: list[dict], model: dict) -> np.ndarray:
        """The parent's probability of each pair's word."""
        n, d, theta = model["customers"], model["d_parent"], model["theta"]
        rest = (theta + d * model["tables"]) / (theta + n) / (model["known"] + 1)
        own = [(unpack(r["a"]) - d * unpack(r["b"])) / (theta + n) + rest for r in answers]
        return np.concatenate([*own, [rest]])[self.word]


def _seat_contexts(ranges: int, model: dict | None, seed: tuple, candidates: int):
    """Redraws the tables of a bucket's contexts (without model: one table a pair)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, kinds in groups(batches):
            [r] = kinds[REPEATED]
            b = _Contexts(r)
            words, large = b.words[:r["x"]], b.words[r["x"]:]
            t = np.ones(len(b.c), np.int64)
            if model is not None:
                t = unpack(kinds[SEATS][0]["a"])
                own = b.extra + np.bincount(b.at, t, len(b.contexts)).astype(np.int64)
                others = b.tables(own, kinds[CONTEXT])[b.at] - t
                t = seat(b.c, others, b.parent(kinds[ANSWER], model), model["theta"], model["d"],
                         np.random.default_rng([*seed, number]), candidates)
            yield row(number, SEATS, a=pack(t))
            sums = np.bincount(b.word, t, len(words)).astype(np.int64)
            edges = np.append(np.flatnonzero(np.diff(words % ranges, prepend=-1)), len(words))
            for i, j in zip(edges[:-1], edges[1:]):
                yield row(int(words[i] % ranges), PARENT, number, a=pack_sorted(words[i:j]),
                          b=pack(sums[i:j]))
            own = b.extra + np.bincount(b.at, t, len(b.contexts)).astype(np.int64)
            for u, n in zip(large.tolist(), own[np.searchsorted(b.contexts, large)].tolist()):
                yield row(number, CONTEXT, u, total=n)
    return run


def _seat_parent(model: dict | None, seed: tuple, candidates: int):
    """Redraws the tables of a range of the parent's words, and answers the buckets.
    The range's own row holds words, customers that never change, customers, tables."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, kinds in groups(batches):
            if model is None:
                words, _, at = ranked(np.concatenate(
                    [unpack_sorted(r["a"]) for r in kinds[ALL_WORDS]]))
                fixed = np.bincount(at, np.concatenate([unpack(r["b"]) for r in kinds[ALL_WORDS]]),
                                    len(words)).astype(np.int64)
            else:
                [before] = kinds[SEATS]
                words, fixed = unpack_sorted(before["a"]), unpack(before["b"])
            asked = [np.searchsorted(words, unpack_sorted(r["a"])) for r in kinds[PARENT]]
            c = fixed.copy()
            for r, at in zip(kinds[PARENT], asked):
                c[at] += unpack(r["b"])
            t = np.minimum(c, 1)
            if model is not None:
                t = seat(c, model["tables"] - unpack(before["d"]),
                         np.full(len(c), 1 / (model["known"] + 1)), model["theta"],
                         model["d_parent"], np.random.default_rng([*seed, number]), candidates)
            yield row(number, SEATS, int(c.sum()), total=int(t.sum()), x=int((c == 1).sum()),
                      y=int((c == 2).sum()), a=pack_sorted(words), b=pack(fixed), c=pack(c),
                      d=pack(t))
            for r, at in zip(kinds[PARENT], asked):
                yield row(r["src"], ANSWER, number, a=pack(c[at]), b=pack(t[at]))
    return run


def _answer_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Customers and tables, in each sample, of all words of each bucket."""
    for number, kinds in groups(batches):
        words = unpack_sorted(kinds[SEATS][0]["a"])
        samples = [(r["y"], unpack(r["c"]), unpack(r["d"])) for r in kinds[SEATS]]
        for r in kinds[ALL_WORDS]:
            at = np.searchsorted(words, unpack_sorted(r["a"]))
            for s, c, t in samples:
                yield row(r["src"], ANSWER, number, y=s, a=pack(c[at]), b=pack(t[at]))


# ---------------------------------------------------------------------------
# 5. Scores
# ---------------------------------------------------------------------------
def _pair_scores(models: list[dict]):
    """log10 of each pair's probability, averaged over the samples (``y``), for the blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, kinds in groups(batches):
            b = _Contexts(kinds[PAIRS][0])
            t, total = np.minimum(b.c, 1), np.zeros(len(b.c))
            for s, model in enumerate(models):
                of = {k: [r for r in kinds[k] if r["y"] == s] for k in (SEATS, CONTEXT, ANSWER)}
                t[b.c > 1] = unpack(of[SEATS][0]["a"])
                own = np.bincount(b.at, t, len(b.contexts)).astype(np.int64)
                new = model["theta"] + model["d"] * b.tables(own, of[CONTEXT])[b.at]
                total += (b.c - model["d"] * t + new * b.parent(of[ANSWER], model)) / (
                    model["theta"] + b.extra[b.at])
            score = np.log10(total / len(models)).astype("<f4").view("<u4").astype(np.int64)
            for r in kinds[PLACES]:
                yield row(r["src"], SCORES, number, a=pack(score[unpack(r["a"])]))
    return run


def _document_scores(buckets: int, split: int, known: int, tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kinds in groups(batches):
            t = _Tokens(kinds[BLOCK][0], kinds[WORDS], buckets, split)
            score = np.concatenate([unpack(r["a"]) for r in kinds[SCORES]])
            score = score.astype("<u4").view("<f4").astype(np.float64)
            base = np.log10((t.count + 1) / (tokens + known + 1))
            sums = [np.add.reduceat(x, t.first) for x in (
                (t.count > 0).astype(np.int64), base, score[t.pair])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(t.uid), pa.array(t.doc_id, mask=t.has_id == 0), pa.array(t.held),
                 pa.array(t.n), *map(pa.array, sums)], schema=_SCORES)
    return run


def score_documents(docs: DataFrame, held_out: Column, *, sweeps: int = SWEEPS,
                    samples: int = SAMPLES, candidates: int = CANDIDATES, theta: float = THETA,
                    seed: int = 11, block_tokens: int = BLOCK_TOKENS,
                    block_bytes: int = BLOCK_BYTES, shard: int = SHARD,
                    split: int = SPLIT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Tokens are the words (runs of bytes other than white space, A-Z lower-cased) and
    one end token.  ``base_score`` is the add-one unigram log10 probability, ``score``
    the model's; both learn from the documents that are not ``held_out`` (null:
    learned from).  With 0 sweeps every pair keeps one table.

    Null and empty texts are an end token alone.  A long text goes on over several
    blocks with its context, so no task holds all its words.  Repeated rows are scored,
    and counted in training, apart.  Rows with a null id get a row with a null id.
    Without training documents every token has probability 1 (the unknown word is all
    there is).  Other columns are not looked at; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "pitman-yor")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.col("text").cast("binary").alias("text"))
    blocks = scratch.write(base.mapInArrow(_blocks(block_tokens, block_bytes), _MAIL), "blocks",
                           by="kind")
    size, entries = blocks.agg(F.sum("total"), F.sum("x")).first()
    shards, buckets = -(-(entries or 1) // shard), -(-(size or 1) // shard)
    vocabulary = scratch.write(gathered(
        blocks.filter(F.col("kind") == WORDS).select("dest", "a", "b")
        .mapInArrow(_to_shards(shards), _MAIL), _count_words(shards)), "vocabulary")
    scratch.drop(f"blocks/kind={WORDS}")
    tokens, known = (n or 0 for n in vocabulary.agg(F.sum("total"), F.sum("x")).first())

    texts = blocks.filter(F.col("kind") == BLOCK).unionByName(vocabulary)
    pairs = scratch.write(gathered(
        gathered(texts, _to_buckets(buckets, split)), _merge_pairs(buckets)), "pairs")

    def kind(df: DataFrame, *kinds: int) -> DataFrame:
        return df.filter(F.col("kind").isin(*kinds))

    once, twice = (n or 0 for n in kind(pairs, PAIRS).agg(F.sum("x"), F.sum("y")).first())
    model = {"theta": theta, "d": discount(once, twice), "known": known}

    def sweep(i: int, state: DataFrame | None, now: dict | None):
        """After sweep i: mail to the buckets, the parent's rows, the model's totals."""
        mail = kind(pairs, REPEATED)
        seats = scratch.write(gathered(
            mail.unionByName(state) if state else mail,
            _seat_contexts(buckets, now, (seed, i, 0), candidates)), f"seats-{i}")
        # The parent's rows of the sweep before; at first, all words of the buckets.
        held = kind(scratch.read(f"parent-{i - 1}", seats), SEATS) if now else \
            kind(pairs, ALL_WORDS)
        parent = scratch.write(gathered(
            kind(seats, PARENT).unionByName(held),
            _seat_parent(now, (seed, i, 1), candidates)), f"parent-{i}")
        own = kind(parent, SEATS)
        sums = own.agg(*[F.sum(c) for c in ("src", "total", "x", "y")]).first()
        customers, tables, one, two = (n or 0 for n in sums)
        # A split context's tables over all its buckets.
        parts = kind(seats, CONTEXT)
        whole = parts.groupBy("src").agg(F.sum("total").alias("total"))
        state = kind(seats, SEATS).unionByName(kind(parent, ANSWER)).unionByName(
            parts.drop("total").join(whole, "src").select(seats.columns))
        return state, own, {**model, "customers": customers, "tables": tables,
                            "d_parent": now["d_parent"] if now else discount(one, two)}

    kept = [sweep(0, None, None)]
    for i in range(1, sweeps + 1):
        kept.append(sweep(i, kept[-1][0], kept[-1][2]))
        if len(kept) > max(1, min(samples, sweeps)):
            kept.pop(0)
            scratch.drop(f"seats-{i - len(kept)}", f"parent-{i - len(kept)}")
    asked, mail = kind(pairs, ALL_WORDS), kind(pairs, PAIRS, PLACES)
    for s, (state, own, _) in enumerate(kept):
        number = F.lit(s).cast("long")
        asked = asked.unionByName(own.withColumn("y", number))
        mail = mail.unionByName(kind(state, SEATS, CONTEXT).withColumn("y", number))
    scores = gathered(mail.unionByName(gathered(asked, _answer_all)),
                      _pair_scores([m for *_, m in kept]))
    parts = (texts.unionByName(scores).repartition("dest")
             .sortWithinPartitions("dest", "kind", "src")
             .mapInArrow(_document_scores(buckets, split, known, tokens),
                         "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, "
                         "base_score double, score double"))
    whole = parts.groupBy("uid").agg(  # a long text has a row in each of its blocks
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", "held_out", "n_tokens", "n_known",
                        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
