"""Words of whole texts and their hashes, vectorised over a slice of documents.

Words are the runs of bytes other than space and 0x09-0x0D.  Every byte of a
multi-byte UTF-8 character is above 0x7F, so splitting bytes equals splitting
characters.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Odd multipliers (fixed values).
BASE_A = 0xD1342543DE82EF95
_CHAIN, _SECOND = np.uint64(BASE_A), np.uint64(0x9E3779B97F4A7C15)
#: Bytes beyond which a word is hashed by itself.
LONG = 64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each word data[start:end).

    Eight bytes a step are mixed into two chains by exclusive-or, product and shift,
    which are not linear together.  The chains shift by different widths, so that a
    difference of bytes which later bytes cancel in one stays in the other; both
    hashes depend on both chains.  Longer words have a BLAKE2b digest.
    """
    padded = np.frombuffer(data + bytes(8), np.uint8)
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = end - start
    a = size.astype(np.uint64) * _SECOND + _CHAIN
    b = size.astype(np.uint64) * _CHAIN + _SECOND
    live, done = np.flatnonzero(size <= LONG), 0
    while len(live):
        left = np.minimum(size[live] - done, 8).astype(np.uint64)
        bits = eight[start[live] + done] << (np.uint64(64) - left * np.uint64(8))
        x, y = (a[live] ^ bits) * _CHAIN, (b[live] ^ bits) * _SECOND
        a[live], b[live] = x ^ x >> np.uint64(29), y ^ y >> np.uint64(32)
        done += 8
        live = live[size[live] > done]
    out = np.stack([mix(a + mix(b)), mix(b ^ a * _SECOND)])
    for i in np.flatnonzero(size > LONG):
        digest = blake2b(data[start[i]:end[i]], digest_size=16).digest()
        out[:, i] = np.frombuffer(digest, "<u8")
    return out


class Words:
    """The words of a list of texts.

    ``first[i]:first[i + 1]`` are the indexes of document i's words; ``hash`` holds
    two 64-bit hashes of each word.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b" ".join(texts) + b" "
        self.joined = joined.lower() if lower else joined  # of bytes: A-Z alone
        data = np.frombuffer(self.joined, np.uint8)
        self.data = data
        word = np.zeros(len(data) + 2, np.int8)
        word[1:-1] = ~_SPACE[data]
        edge = np.diff(word)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)])
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self._hash: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = word_hashes(self.joined, self.start, self.end)
        return self._hash

    def windows(self, start: np.ndarray, size: int, half: int = 0) -> np.ndarray:
        """Hash of the ``size`` words from each word index on, from one of their hashes.
        Words are mixed in by steps that are not linear together, so that no pattern of
        words makes two sequences collide."""
        h, x = self.hash[half], np.full(len(start), size, np.uint64)
        for i in range(size):
            x = (x ^ h[start + i]) * _CHAIN
            x ^= x >> np.uint64(29)
        return mix(x)
