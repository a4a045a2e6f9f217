"""Word shingles as 64-bit hashes, computed in Python workers."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

SHINGLE_WORDS = 5

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits spread over 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Hashes of the word n-grams of texts; A-Z lower-cased, words split at ASCII white space."""

    def __init__(self, width: int = SHINGLE_WORDS):
        self.width = width

    def words(self, text: str | None) -> np.ndarray:
        """One hash per word, in order."""
        found = (text or "").encode().lower().split()
        # a digest is the hash, most significant byte first; a table of known words takes longer
        return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, found)), dtype=">u8").astype(np.uint64)

    def grams(self, words: np.ndarray) -> np.ndarray:
        """The hash of every window; of the whole sequence if it is shorter; none without words."""
        width = min(self.width, words.size)
        if width == 0:
            return np.zeros(0, dtype=np.uint64)
        rows = words.size - width + 1
        acc = np.full(rows, width, dtype=np.uint64)
        for k in range(width):
            acc = mixed(acc ^ words[k : k + rows]) + np.uint64(k + 1)
        return acc

    def set(self, text: str | None) -> np.ndarray:
        """The distinct shingles, in order of their hash."""
        return np.unique(self.grams(self.words(text)))


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
