"""Vectorised word and shingle hashes over UTF-8 bytes (numpy, used inside Python tasks).

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, so the split is the
same as the pattern ``[^\\x20\\x09-\\x0D]+`` over code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE[_SPACE] = 0
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
_ODD = _RNG.integers(0, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """First n powers of an odd base modulo 2**64; the table doubles when a longer word turns up."""
    global _POWER
    if len(_POWER) < n:
        size = max(1024, 2 * n)
        _POWER = np.concatenate([[np.uint64(1)], np.full(size - 1, 0x9E3779B97F4A7C15, dtype=np.uint64)]).cumprod(dtype=np.uint64)
    return _POWER


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 arrays (shifts and odd multiplications)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str | None, fold: bool = False) -> np.ndarray:
    """uint64 hash of each word in order; fold lower-cases A-Z only; null gives no words."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    span = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, span)
    table = _BYTE_FOLDED if fold else _BYTE
    values = table[data[starts[0]:]] * _powers(int(span.max()))[place]
    return mix(np.add.reduceat(values, starts - starts[0]))


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer than k words give one shingle of all, none gives none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        if n < k:
            return mix((words * _ODD[:n]).sum(dtype=np.uint64, keepdims=True) + _ODD[32 + n])
        total = words[: n - k + 1] * _ODD[0]
        for j in range(1, k):
            total = total + words[j : n - k + 1 + j] * _ODD[j]
        return np.unique(mix(total))


def stretches(text: str, boundary: re.Pattern, size: int = 1_000_000) -> Iterator[str]:
    """The text in order, in stretches of about size characters cut only where boundary matches (after its match)."""
    at = 0
    while len(text) - at > size and (found := boundary.search(text, at + size)):
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]
