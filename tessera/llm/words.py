"""Words of UTF-8 texts as 64-bit hashes, without a Python step per word.

A word is a run of ASCII letters, digits and bytes from 0x80 on; A-Z count as a-z. A polynomial hash of every
word comes from one running sum over the bytes of many texts, so a batch costs a few numpy passes.
"""
from __future__ import annotations

import numpy as np

WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size, out = max(n, _BLOCK + 4096), []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[:] = out
    return _powers[0], _powers[1]


def _block(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    a = np.frombuffer(buf, np.uint8)
    word = a != 32
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    up, down = _power(len(a))
    run = np.cumsum(_BYTE[a] * up[: len(a)], dtype=np.uint64)
    low = np.where(starts > 0, run[starts - 1], _U(0))
    return mix((run[ends - 1] - low) * down[starts]), starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and offsets: text i has hashes[offsets[i]:offsets[i + 1]]."""
    buf = b" ".join(texts).translate(WORD) if texts else b""
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    hashes, places, at = [], [], 0
    while at < len(buf):
        end = len(buf) if len(buf) - at <= _BLOCK else buf.find(b" ", at + _BLOCK)
        end = len(buf) if end < 0 else end
        h, s = _block(buf[at:end])
        hashes.append(h)
        places.append(s + at)
        at = end
    h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    s = np.concatenate(places) if places else np.empty(0, np.int64)
    return h, np.searchsorted(s, begins)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of width words; of all words where there are fewer, but not none."""
    n = len(h)
    if not n:
        return np.empty(0, np.uint64)
    w = min(width, n)
    out = np.zeros(n - w + 1, np.uint64)
    for j in range(w):
        out = (out + h[j : n - w + 1 + j]) * _U(_BASE)
        out ^= out >> _U(32)
    return mix(out + _U(w))


def occurrences(sorted_values: np.ndarray) -> np.ndarray:
    """For sorted values: how many equal ones stand before each."""
    n = len(sorted_values)
    if not n:
        return np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
