"""Vectorised hashing of byte strings in numpy: words, shingles and windows of fixed length."""

from __future__ import annotations

import ctypes
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_pow = _inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse modulo 2**64, i < n."""
    global _pow, _inv
    if len(_pow) < n:
        n = 1 << (n - 1).bit_length()
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        _pow, _inv = out
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Sums(NamedTuple):
    """Of a byte string: prefix sums of a polynomial, and the four bytes from each place on."""
    s: np.ndarray
    four: np.ndarray


def sums(b: np.ndarray) -> Sums:
    """The polynomial's coefficients are mixed runs of four bytes, not single ones: a polynomial
    of two letters modulo 2**64 has strings of 1024 letters (Thue-Morse) that collide for any base."""
    n = len(b)
    p, _ = _powers(n + 1)
    pad = np.concatenate([b, np.zeros(3, np.uint8)]).astype(np.uint32)
    four = pad[:n] | pad[1:n + 1] << np.uint32(8) | pad[2:n + 2] << np.uint32(16) | pad[3:n + 3] << np.uint32(24)
    out = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mix(four + np.uint64(1)) * p[:n], dtype=np.uint64, out=out[1:])
    return Sums(out, four)


_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], np.uint32)


def spans(x: Sums, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of b[start:end], from sums(b). Equal strings have equal hashes wherever they lie."""
    _, inv = _powers(len(x.s))
    size = end - start
    with np.errstate(over="ignore"):
        out = (x.s[np.maximum(end - 3, start)] - x.s[start]) * inv[start]
        short = np.flatnonzero(size < 4)
        if len(short) and len(x.four):
            out[short] = mix((x.four[np.minimum(start[short], len(x.four) - 1)] & _MASKS[size[short]]).astype(np.uint64))
        return mix(out + size.astype(np.uint64))


def windows(x: Sums, k: int) -> np.ndarray:
    """Hashes of all substrings of length k, four at least."""
    n = len(x.s) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, inv = _powers(len(x.s))
    with np.errstate(over="ignore"):
        return mix((x.s[k - 3:k - 3 + n] - x.s[:n]) * inv[:n])


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than ASCII white space."""
    ink = np.zeros(len(b) + 2, np.int8)
    ink[1:-1] = ~_WHITE[b]
    step = np.diff(ink)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(b: np.ndarray) -> np.ndarray:
    """Lower-cases A-Z alone."""
    return _LOWER[b]


def chunks(texts: list, most: int = 1 << 18):
    """Runs of texts of about `most` bytes: (first index, concatenated UTF-8 with a line feed
    after each, start of each). A longer text is a run of its own."""
    held, first, size = [], 0, 0
    for i, t in enumerate(texts):
        raw = t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > most:
            yield first, *_join(held)
            held, first, size = [], i, 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, *_join(held)


def _join(held: list) -> tuple[np.ndarray, np.ndarray]:
    starts = np.zeros(len(held) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in held], out=starts[1:])
    return np.frombuffer(b"\n".join([*held, b""]), np.uint8), starts


def lean(task):
    """A task for mapInArrow that gives freed memory back to the machine, now and then and at its
    end: workers are used again, and what one stage needed would stay with them."""
    def run(batches):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: None)
        for i, out in enumerate(task(batches)):
            yield out
            if i % 16 == 15:
                trim(0)
        del batches
        pa.default_memory_pool().release_unused()
        trim(0)
    return run
