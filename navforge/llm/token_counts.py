"""Unigram token counts by dynamic programming over a trie of pre-tokens (operator 6).

A pre-token is a word with the mark U+2581 before it.  Its best segmentation into
pieces of a public vocabulary maximises the sum of log probabilities; the
vocabulary file's ranks give them by Zipf's law, and any byte is a piece of the
least probability.  The distinct pre-tokens of a slice of documents, sorted,
form a trie whose nodes are their prefixes: a word opens a node at each depth
beyond what it shares with the word before it.  Forward scores are computed
depth by depth for new nodes only, all of them at once, and copied to the words
below; depths that few words reach are computed word by word, again for new nodes
only.  The node where a word ends stores its token count and score, and documents
add up the terminal counts of their words.  Nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import ship, text_slices
from navforge.llm.words import BASE_A, Words, mix

MARK = "▁".encode()
#: Words that must reach a depth for its nodes to be computed together.
FEW = 256
#: Bytes of a long word scored at a time, and of the heads compared in one matrix.
BLOCK, HEAD = 1 << 16, 64
SLICE = 2 << 20
_BASE = np.uint64(BASE_A)


def load_pieces(path: str) -> dict[bytes, float]:
    """Log probabilities of a sentencepiece file's pieces, from their ranks."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked = [sp.id_to_piece(i).encode() for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    total = math.log(sum(1 / (r + 10) for r in range(len(ranked) + 256)))
    out = {p: -math.log(r + 10) - total for r, p in enumerate(ranked)}
    least = -math.log(len(ranked) + 266) - total
    for b in range(256):
        out.setdefault(bytes([b]), least)
    return out


class Vocabulary:
    """Pieces in an open-addressing table that numpy looks up many at a time."""

    def __init__(self, pieces: dict[bytes, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        bits = max(4, (4 * len(pieces)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.value = np.full(1 << bits, -np.inf)
        self.probes = 1
        for p, v in pieces.items():
            h = 0
            for b in p:
                h = (h * int(_BASE) + b + 1) & ((1 << 64) - 1)
            key = int(self.key(np.array([h], np.uint64), len(p))[0])
            at, n = key & int(self.mask), 1
            while self.keys[at]:
                at, n = (at + 1) & int(self.mask), n + 1
            self.keys[at], self.value[at] = key, v
            self.probes = max(self.probes, n)
        self.lengths = sorted({len(p) for p in pieces})
        # Lengths (bits, modulo 64) of the pieces that end with four given bytes.
        self.ends = np.zeros(1 << 20, np.uint64)
        for p in pieces:
            if len(p) >= 4:
                four = np.frombuffer(p[-4:], "<u4")
                self.ends[self.slot(four)] |= np.uint64(1 << len(p) % 64)

    @staticmethod
    def slot(four: np.ndarray) -> np.ndarray:
        return (four * np.uint32(0x9E3779B1)) >> np.uint32(12)

    @staticmethod
    def key(h: np.ndarray, length: int) -> np.ndarray:
        return mix(h ^ np.uint64(length * 0x9E3779B9)) | np.uint64(1)

    def lookup(self, h: np.ndarray, length: int) -> np.ndarray:
        """Log probability of each hashed piece, -inf where there is none."""
        key = self.key(h, length)
        at = key & self.mask
        out = np.where(self.keys[at] == key, self.value[at], -np.inf)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + np.uint64(1)) & self.mask
            found = self.keys[at[open_]]
            hit = open_[found == key[open_]]
            out[hit] = self.value[at[hit]]
            open_ = open_[(found != key[open_]) & (found != 0)]
        return out


def one_word(word: bytes, pieces: dict[bytes, float], longest: int) -> tuple[int, float]:
    """Tokens and score of the best segmentation; ties go to the longer last piece."""
    score, count = [0.0], [0]
    for d in range(1, len(word) + 1):
        best, n = -math.inf, 0
        for size in range(min(d, longest), 0, -1):
            v = pieces.get(word[d - size:d])
            if v is not None and score[d - size] + v > best:
                best, n = score[d - size] + v, count[d - size] + 1
        score.append(best)
        count.append(n)
    return count[-1], score[-1]


def shared_bytes(words: list[bytes]) -> np.ndarray:
    """Bytes that each of the sorted words has in common with the word before it."""
    n = len(words)
    size = np.array([len(w) for w in words], np.int64)
    head = np.zeros((n, HEAD + 1), np.uint8)
    kept = np.minimum(size, HEAD)
    head[np.repeat(np.arange(n), kept),
         np.arange(kept.sum()) - np.repeat(np.cumsum(kept) - kept, kept)] = \
        np.frombuffer(b"".join(w[:HEAD] for w in words), np.uint8)
    differ = head[1:] != head[:-1]
    differ[:, -1] = True
    out = np.zeros(n, np.int64)
    out[1:] = np.minimum(differ.argmax(axis=1), size[:-1])
    for i in np.flatnonzero(out == HEAD):  # equal as far as the matrix goes
        a, b = words[i - 1], words[i]
        low, high = HEAD, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            if a[low:middle] == b[low:middle]:
                low = middle
            else:
                high = middle - 1
        out[i] = low
    return out


class _Trie:
    """Sorted distinct words end to end; a node is the byte where its prefix first ends."""

    def __init__(self, words: list[bytes], vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.size = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.base = self.start + np.arange(len(words))  # of depth 0 in score and count
        self.shared = shared_bytes(words)
        data = np.frombuffer(b"".join(words), np.uint8)
        step = np.full(len(data), _BASE)
        step[:1] = 1
        self.power = np.multiply.accumulate(step)
        step[1:] = pow(int(_BASE), -1, 1 << 64)
        self.chain = np.zeros(len(data) + 1, np.uint64)
        self.chain[1:] = np.cumsum((data.astype(np.uint64) + np.uint64(1))
                                   * np.multiply.accumulate(step))
        wide = np.concatenate([np.zeros(3, np.uint8), data])
        four = np.zeros(len(data), np.uint32)
        for i in range(4):
            four |= wide[i:i + len(data)].astype(np.uint32) << np.uint32(8 * i)
        self.four = four
        self.score = np.zeros(len(data) + len(words))
        self.count = np.zeros(len(data) + len(words), np.int32)

    def pieces(self, at: np.ndarray, depth: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into ``at``, length, log probability) of the pieces that end at these
        bytes, longer pieces of a byte first."""
        where, length, value = [], [], []
        ends = self.vocabulary.ends[self.vocabulary.slot(self.four[at])]
        for k in reversed(self.vocabulary.lengths):
            fits = depth >= k
            if k >= 4:
                fits &= (ends >> np.uint64(k % 64)) & np.uint64(1) != 0
            i = np.flatnonzero(fits)
            if len(i):
                end = at[i] + 1
                v = self.vocabulary.lookup(
                    (self.chain[end] - self.chain[end - k]) * self.power[at[i]], k)
                hit = np.flatnonzero(v > -np.inf)
                where.append(i[hit])
                length.append(np.full(len(hit), k))
                value.append(v[hit])
        where = np.concatenate(where)
        order = np.argsort(where, kind="stable")
        return where[order], np.concatenate(length)[order], np.concatenate(value)[order]

    def across(self, below: int) -> None:
        """Forward scores of all nodes of depth less than ``below``, a depth at a time."""
        alive = np.flatnonzero(self.size)
        for d in range(1, below):
            alive = alive[self.size[alive] >= d]
            new = self.shared[alive] < d
            word = alive[new]
            node, k, v = self.pieces(self.start[word] + d - 1, np.full(len(word), d))
            here = self.base[word] + d
            s = self.score[here[node] - k] + v
            first = np.flatnonzero(np.diff(node, prepend=-1))
            best = np.maximum.reduceat(s, first)
            top = np.flatnonzero(s == best[node])[::-1]
            chosen = np.empty(len(word), np.int64)
            chosen[node[top]] = top  # the longest of the best, written last
            self.score[here] = best
            self.count[here] = self.count[here - k[chosen]] + 1
            # Words that share the node take over what its first word computed.
            owner = alive[np.maximum.accumulate(np.where(new, np.arange(len(alive)), 0))]
            self.score[self.base[alive] + d] = self.score[self.base[owner] + d]
            self.count[self.base[alive] + d] = self.count[self.base[owner] + d]

    def along(self, words: np.ndarray, depth: int) -> None:
        """Forward scores of these words' own nodes from ``depth`` on, word by word; pieces
        are looked up for a block of bytes at a time."""
        spans, held = [], 0
        for word in words.tolist():
            at, size = max(depth, int(self.shared[word]) + 1), int(self.size[word])
            while at <= size:
                end = min(size + 1, at + BLOCK - held)
                spans.append((word, at, end))
                held, at = held + end - at, end
                if held == BLOCK:
                    self._spans(spans, depth)
                    spans, held = [], 0
        if spans:
            self._spans(spans, depth)

    def _spans(self, spans: list[tuple[int, int, int]], depth: int) -> None:
        depths = np.concatenate([np.arange(a, b) for _, a, b in spans])
        starts = np.repeat(self.start[[w for w, _, _ in spans]], [b - a for _, a, b in spans])
        node, k, v = self.pieces(starts + depths - 1, depths)
        cut = np.searchsorted(node, np.cumsum([0] + [b - a for _, a, b in spans])).tolist()
        rank, k, v = depths[node].tolist(), k.tolist(), v.tolist()
        for (word, at, end), x, y in zip(spans, cut, cut[1:]):
            base, common = int(self.base[word]), int(self.shared[word])
            if at == common + 1 and common >= depth:  # nodes of the word before
                before = int(self.base[word - 1])
                for table in (self.score, self.count):
                    table[base + depth:base + at] = table[before + depth:before + at]
            low = max(0, at - self.vocabulary.longest)
            score = self.score[base + low:base + end].tolist()
            count = self.count[base + low:base + end].tolist()
            last = -1
            for d, j, p in zip(rank[x:y], k[x:y], v[x:y]):
                i = d - low
                p += score[i - j]
                if i != last or p > score[i]:
                    last, score[i], count[i] = i, p, count[i - j] + 1
            self.score[base + low:base + end] = score
            self.count[base + low:base + end] = count


def trie_counts(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Terminal counts and scores of distinct sorted words of any length.

    Depths that at least ``FEW`` words reach are computed for all their nodes at once,
    the deeper ends of the few longest words one after the other.
    """
    trie = _Trie(words, vocabulary)
    longest = np.sort(trie.size)[::-1]
    below = int(longest[FEW - 1]) + 1 if len(words) >= FEW else 1
    trie.across(below)
    trie.along(np.flatnonzero(trie.size >= below), below)
    last = trie.base + trie.size
    return trie.count[last], trie.score[last]


def distinct_words(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(a word of each kind, the kind of each word), told apart by 128 bits."""
    one, two = w.hash
    _, first, inverse = np.unique(one, return_index=True, return_inverse=True)
    if (two != two[first][inverse]).any():  # equal in the first 64 bits only
        _, first, inverse = np.unique(w.hash, axis=1, return_index=True, return_inverse=True)
    return first, inverse.ravel()


_vocabularies: dict[str, Vocabulary] = {}


def _counted(path: str, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _vocabularies:
            _vocabularies[path] = Vocabulary(load_pieces(path))
        vocabulary = _vocabularies[path]
        for batch in batches:
            for part, texts in text_slices(batch, "__text", SLICE):
                w = Words(texts)
                first, inverse = distinct_words(w)
                data = w.data.tobytes()
                distinct = [MARK + data[a:b] for a, b in zip(w.start[first], w.end[first])]
                order = sorted(range(len(distinct)), key=distinct.__getitem__)
                tokens, score = np.zeros(len(distinct), np.int64), np.zeros(len(distinct))
                if order:
                    tokens[order], score[order] = trie_counts([distinct[i] for i in order],
                                                              vocabulary)
                total = np.bincount(w.doc, tokens[inverse], len(texts)).astype(np.int64)
                logp = np.bincount(w.doc, score[inverse], len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in columns),
                     pa.array(w.count, pa.int64()), pa.array(total), pa.array(logp)],
                    names=[*columns, "__n_pretokens", "__n_tokens", "__log_probability"])
    return run


def count_tokens(docs: DataFrame, pieces_path: str) -> DataFrame:
    """``docs`` with n_pretokens, n_tokens and log_probability of each whole text
    (null and empty: 0).  Columns of these names are replaced.

    Repeated rows are counted each.  A very long text is read whole; a word takes
    some 40 bytes of memory for each of its own, however long it is.
    """
    ship(docs.sparkSession)
    docs = docs.drop("n_pretokens", "n_tokens", "log_probability")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return (docs.withColumn("__text", F.col("text").cast("binary"))
            .mapInArrow(_counted(pieces_path, docs.columns),
                        f"{fields}, __n_pretokens long, __n_tokens long, "
                        "__log_probability double")
            .withColumnsRenamed({f"__{c}": c for c in
                                 ("n_pretokens", "n_tokens", "log_probability")}))
