"""A cuckoo filter: approximate membership that supports deletion."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 500


def _print(high: np.ndarray) -> np.ndarray:
    """16 bits that stand for a key in the filter; never zero."""
    short = (high.astype(np.uint64) >> np.uint64(40)) & np.uint64(0xFFFF)
    return np.where(short == 0, 1, short).astype(np.uint64)


def _jump(prints: np.ndarray, mask: int) -> np.ndarray:
    return ((prints * np.uint64(0x5BD1E995)) >> np.uint64(3)) & np.uint64(mask)


class CuckooFilter:
    """Fingerprints in buckets of four; a key may lie in either of two buckets.

    Keys are pairs of 64-bit hashes. Deleting is safe for keys that were
    inserted. Beyond 95 % the table doubles, which needs the keys again, so
    ``insert`` returns False and the owner rebuilds.
    """

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = table.shape[0] - 1

    @classmethod
    def sized_for(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * 0.85 < keys + 1:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> CuckooFilter:
        room = high.size
        while True:
            made = cls.sized_for(room)
            if made.insert(high, low):
                return made
            room = 2 * room + SLOTS

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, high, low):
        prints = _print(high)
        first = low.astype(np.uint64) & np.uint64(self.mask)
        return prints, first, first ^ _jump(prints, self.mask)

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(high, low)
        here = self.table[first] == prints[:, None]
        there = self.table[second] == prints[:, None]
        return here.any(axis=1) | there.any(axis=1)

    def insert(self, high: np.ndarray, low: np.ndarray) -> bool:
        rows = self.table.tolist()
        jumps = {}
        done = True
        for mark, at, other in zip(*(x.tolist() for x in self._places(high, low)), strict=True):
            if not (_put(rows[at], mark) or _put(rows[other], mark)):
                done = self._kick(rows, mark, other, jumps)
                if not done:
                    break
        self.table = np.array(rows, dtype=np.uint16).reshape(-1, SLOTS)
        return done

    def _kick(self, rows, mark: int, at: int, jumps: dict) -> bool:
        """Move fingerprints to their other bucket until one finds room."""
        for turn in range(KICKS):
            slot = (turn + mark) % SLOTS
            mark, rows[at][slot] = rows[at][slot], mark
            if mark not in jumps:
                jumps[mark] = int(_jump(np.array([mark], dtype=np.uint64), self.mask)[0])
            at ^= jumps[mark]
            if _put(rows[at], mark):
                return True
        return False

    def delete(self, high: np.ndarray, low: np.ndarray) -> None:
        for mark, at, other in zip(*(x.tolist() for x in self._places(high, low)), strict=True):
            for place in (at, other):
                slots = np.flatnonzero(self.table[place] == mark)
                if slots.size:
                    self.table[place, slots[0]] = 0
                    break


def _put(bucket: list[int], mark: int) -> bool:
    for slot in range(SLOTS):
        if bucket[slot] == 0:
            bucket[slot] = mark
            return True
    return False
