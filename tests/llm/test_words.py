from __future__ import annotations

import random

import numpy as np

from navforge.llm.words import LONG, Words


def test_words_and_their_hashes():
    """Equal words have equal hashes, others differ, whatever surrounds them."""
    rng = random.Random(1)
    words = {b"a", b"b", b"ab", b"ba", b"\x00", b"\x00\x00", b"a\x00", b"\x00a", b"x" * 8, b"x" * 9}
    words |= {bytes(rng.choices(b"ab\x00\x80\xff", k=rng.randint(1, 2 * LONG))) for _ in range(5000)}
    for size in (LONG - 1, LONG, LONG + 1, 1024, 4096):
        words |= {b"a" * size, b"a" * (size - 1) + b"b", b"b" + b"a" * (size - 1)}
    # Differences of the highest bits of one chunk and of what it leaves in the next.
    for bits in ((63, 34), (63, 31), (63,)):
        tail = sum(1 << b for b in bits).to_bytes(8, "little")
        words |= {bytes(8) + bytes(8) + b"q", (1 << 63).to_bytes(8, "little") + tail + b"q"}
    words = sorted(w for w in words if len(w.split()) == 1 and w.split()[0] == w)
    texts = [b" ".join(rng.choices(words, k=50)) + b"\t\n" for _ in range(400)] + [b"", b" "]
    w = Words(texts)
    flat = [x for t in texts for x in t.split()]
    assert [w.joined[i:j] for i, j in zip(w.start, w.end)] == flat
    assert w.count.tolist() == [len(t.split()) for t in texts]
    for half in range(2):
        assert len(np.unique(w.hash[half])) == len(set(flat))
        assert len(set(zip(flat, w.hash[half].tolist()))) == len(set(flat))


def test_sequences_of_two_words():
    rng = random.Random(2)
    texts = [b" ".join(rng.choice([b"u", b"v"]) for _ in range(300)) for _ in range(20)]
    w = Words(texts)
    at = np.concatenate([np.arange(w.first[i], w.first[i + 1] - 19) for i in range(20)])
    flat = [x for t in texts for x in t.split()]
    for half in range(2):
        h = w.windows(at, 20, half)
        assert len(np.unique(h)) == len({tuple(flat[i:i + 20]) for i in at})
