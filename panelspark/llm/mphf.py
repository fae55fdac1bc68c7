"""A minimal perfect hash of distinct 64-bit keys, built and looked up in numpy.

Level by level the keys that are left are hashed into a table of twice their number; a key alone in its place is settled
there, and its index is the number of settled places before it. Keys that share a place go on to the next level. That
takes about three bits a key; the keys themselves, in the order of their indexes, verify a lookup.
"""

from __future__ import annotations

import numpy as np

from panelspark.llm._text import mix

ROOM = 2


class PerfectHash:
    """Index 0 to n - 1 for each of n distinct keys."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.before: list[np.ndarray] = []
        settled = 0
        for bits in levels:
            ranks = settled + np.cumsum(bits, dtype=np.int64)
            self.before.append(ranks - bits)
            settled = int(ranks[-1])
        self.n = settled

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(keys + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct uint64 keys, in any order; repeated keys would never be alone and are refused."""
        if len(np.unique(keys)) != len(keys):
            raise ValueError("the keys aren't distinct")
        levels, rest = [], keys
        while len(rest):
            size = ROOM * len(rest) + 1
            places = cls._places(rest, len(levels), size)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[places]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; a key that isn't one of the n gets -1 or some other key's index, which its stored key shows."""
        found = np.full(len(keys), -1, dtype=np.int64)
        rest = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.levels, self.before, strict=True)):
            places = self._places(keys[rest], level, len(bits))
            hit = bits[places]
            found[rest[hit]] = before[places[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
        return found

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], dtype="<u8")
        return sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, dtype="<u8", count=1)[0])
        sizes, at, levels = np.frombuffer(data, dtype="<u8", count=n, offset=8).astype(int), 8 * (n + 1), []
        for size in sizes:
            held = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, dtype=np.uint8, count=held, offset=at), count=size).astype(bool))
            at += held
        return cls(levels)


def verified_index(table: PerfectHash, keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key, whose stored key must equal it; else LookupError."""
    at = table.index(wanted)
    if len(wanted) and ((at < 0).any() or (keys[at] != wanted).any()):
        raise LookupError("a key was not among those that the hash was built from")
    return at
