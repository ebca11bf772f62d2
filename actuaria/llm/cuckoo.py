"""A cuckoo filter of 16-bit fingerprints with deletion, stored as bytes."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MOST_KICKS = 500


class Full(Exception):
    """No place for a fingerprint: rebuild the filter from the exact keys with more buckets."""


class CuckooFilter:
    """Buckets of four fingerprints; a key's two buckets follow from its 16-byte digest.

    A key that was added is always found.  Removing takes one copy of the
    fingerprint away, so only keys that were added may be removed.
    """

    def __init__(self, buckets: int = 64, cells: np.ndarray | None = None):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.cells = np.zeros((buckets, SLOTS), dtype=np.uint16) if cells is None else cells

    @classmethod
    def of_bytes(cls, data: bytes | None) -> CuckooFilter:
        if not data:
            return cls()
        return cls(cells=np.frombuffer(data, dtype="<u2").reshape(-1, SLOTS).copy())

    @classmethod
    def of_keys(cls, keys: list[bytes]) -> CuckooFilter:
        """A filter of these keys, with as many buckets as they need."""
        buckets = 64
        while buckets * SLOTS * 0.85 < len(keys):
            buckets *= 2
        while True:
            built = cls(buckets)
            try:
                for key in keys:
                    built.add(key)
                return built
            except Full:
                buckets *= 2

    def to_bytes(self) -> bytes:
        return self.cells.astype("<u2").tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """keys: (n, 16) bytes → fingerprints (never 0), first and second buckets."""
        parts = keys.view("<u8").reshape(-1, 2)
        prints = (parts[:, 1] >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        mask = len(self.cells) - 1
        first = (parts[:, 1] & np.uint64(0xFFFFFFFF)).astype(np.int64) & mask
        return prints, first, first ^ (self._spread(prints) & mask)

    @staticmethod
    def _spread(prints: np.ndarray) -> np.ndarray:
        return (prints.astype(np.int64) * 0x5BD1E995) >> 5 | 1

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, dtype=bool)
        prints, first, second = self._places(np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, 16))
        sought = prints[:, None]
        return (self.cells[first] == sought).any(axis=1) | (self.cells[second] == sought).any(axis=1)

    def add(self, key: bytes) -> None:
        prints, first, second = self._places(np.frombuffer(key, dtype=np.uint8).reshape(1, 16))
        mark, here = int(prints[0]), int(first[0])
        mask = len(self.cells) - 1
        for bucket in (here, int(second[0])):
            free = np.flatnonzero(self.cells[bucket] == 0)
            if len(free):
                self.cells[bucket, free[0]] = mark
                return
        for kick in range(MOST_KICKS):
            slot = (mark + kick) % SLOTS
            mark, self.cells[here, slot] = int(self.cells[here, slot]), mark
            here ^= int(self._spread(np.array([mark], dtype=np.uint16))[0]) & mask
            free = np.flatnonzero(self.cells[here] == 0)
            if len(free):
                self.cells[here, free[0]] = mark
                return
        raise Full

    def remove(self, key: bytes) -> bool:
        prints, first, second = self._places(np.frombuffer(key, dtype=np.uint8).reshape(1, 16))
        for bucket in (int(first[0]), int(second[0])):
            held = np.flatnonzero(self.cells[bucket] == prints[0])
            if len(held):
                self.cells[bucket, held[0]] = 0
                return True
        return False
