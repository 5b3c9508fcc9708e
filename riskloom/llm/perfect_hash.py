"""A minimal perfect hash: n distinct 64-bit hashes onto 0..n-1, with no key stored.

Level by level each key picks a bit; keys alone on their bit stay, the others go on to the next
level. A key's number is the rank of its bit among all set bits, read from one word of bits and
one running count, so a lookup takes a few steps whatever n is. Fingerprints tell strangers."""

from __future__ import annotations

import numpy as np

from riskloom.llm.words import mixed

_ROOM, _MOST_LEVELS = 2, 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


def key_hash(ids: np.ndarray, occurrence: np.ndarray, absent: np.ndarray) -> np.ndarray:
    """One hash for each (id, how often it came before, whether it is null)."""
    salt = mixed((occurrence.astype(np.uint64) << np.uint64(1)) + absent.astype(np.uint64))
    return mixed(ids.astype(np.int64).view(np.uint64) + salt)


def _bit(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return mixed(hashes + mixed(np.array([level + 1], np.uint64))) % np.uint64(size)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes ^ _STEP) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, sizes: np.ndarray, words: np.ndarray, before: np.ndarray):
        self.sizes, self.words, self.before = sizes, words, before
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], hashes
        while len(left):
            if len(sizes) == _MOST_LEVELS:
                raise ValueError("keys are not distinct")
            size = -(-max(64, _ROOM * len(left)) // 64) * 64
            at = _bit(left, len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        words = np.packbits(flat, bitorder="little").view(np.uint64)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words))[:-1]]).astype(np.uint32) if len(words) else np.zeros(0, np.uint32)
        return cls(np.array(sizes, np.int64), words, before)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where no bit is set for it."""
        found = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            at = _bit(hashes[open_], level, int(size)).astype(np.int64) + self.starts[level]
            word, within = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> within) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << within) - np.uint64(1)))
            found[open_[hit]] = (self.before[at >> 6] + below)[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        return found

    def to_arrays(self) -> dict[str, np.ndarray]:
        return {"sizes": self.sizes, "words": self.words, "before": self.before}
