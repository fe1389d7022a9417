import random

import numpy as np

from pelagos.llm import bytehash as bh


def one(raw, start, end):
    return int(bh.spans(bh.sums(np.frombuffer(raw, np.uint8)), np.array([start]), np.array([end]))[0])


def test_equal_strings_have_equal_hashes():
    rng = random.Random(1)
    for n in [*range(0, 12), 100, 5000]:
        x = rng.randbytes(n)
        a, b = rng.randbytes(7) + x + rng.randbytes(3), rng.randbytes(40) + x
        assert one(a, 7, 7 + n) == one(b, 40, 40 + n) == one(x, 0, n) or n == 0
    raw = rng.randbytes(300)
    s = bh.sums(np.frombuffer(raw, np.uint8))
    h = bh.windows(s, 40)
    assert len(h) == 261 and len(set(h.tolist())) == 261
    assert (bh.windows(bh.sums(np.frombuffer(raw[7:], np.uint8)), 40) == h[7:]).all()


def test_different_strings_differ():
    strings = {bytes(x) for n in range(1, 4) for x in np.ndindex(*[8] * n)} | {bytes(n) for n in range(1, 300)} | {b"ab" * n for n in range(1, 200)}
    assert len({one(x, 0, len(x)) for x in strings}) == len(strings)


def test_thue_morse_words_differ():
    word, other = b"a", b"b"
    for _ in range(13):
        word, other = word + other, other + word
    assert one(word, 0, len(word)) != one(other, 0, len(other))
