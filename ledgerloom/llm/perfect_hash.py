"""Minimal perfect hashing of (document id, occurrence) keys with NumPy.

Every key is hashed to a bit array of about twice the number of keys. Keys that are alone on
their bit are placed; the others try again on the next, smaller array with another hash. The slot
of a key is the number of set bits before its own, so ``n`` keys get the slots 0 to n-1.
"""

from __future__ import annotations

import struct

import numpy as np
import xxhash

_SPREAD = 2.0
_MAX_LEVELS = 200
_FINGERPRINT_SALT = 255
_NULL_ID = np.uint64(0x9E3779B97F4A7C15)
_SEED = 42


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64); wraps around on purpose."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Keys:
    """Two words per key: the id (a constant if null) and the occurrence with a null mark."""

    def __init__(self, ids: np.ndarray, is_null: np.ndarray, occurrence: np.ndarray):
        ids = np.where(is_null, 0, ids).astype(np.int64).view(np.uint64)
        self.first = np.where(is_null, _NULL_ID, ids)
        self.second = occurrence.astype(np.uint64) * np.uint64(2) + is_null.astype(np.uint64)

    def hashed(self, salt: int, at: np.ndarray | None = None) -> np.ndarray:
        a, b = (self.first, self.second) if at is None else (self.first[at], self.second[at])
        with np.errstate(over="ignore"):
            salted = _mix(a + np.uint64(salt + 1) * np.uint64(0x9E3779B97F4A7C15))
            return _mix(salted ^ _mix(b + np.uint64(salt)))

    def fingerprints(self) -> np.ndarray:
        return (self.hashed(_FINGERPRINT_SALT) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Level sizes in bits (multiples of 64), the bit words, and set bits before each word."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes.astype(np.uint64), words.astype(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.cumsum(counts, dtype=np.uint32) - counts

    @classmethod
    def build(cls, keys: Keys) -> PerfectHash:
        left = np.arange(len(keys.first))
        sizes, words = [], []
        while len(left):
            if len(sizes) >= _MAX_LEVELS:
                raise ValueError("keys are not distinct")
            bits = max(64, -(-int(_SPREAD * len(left)) // 64) * 64)
            at = keys.hashed(len(sizes), left) % np.uint64(bits)
            alone = np.bincount(at.astype(np.int64), minlength=bits)[at.astype(np.int64)] == 1
            level = np.zeros(bits, dtype=np.uint8)
            level[at[alone].astype(np.int64)] = 1
            words.append(np.packbits(level, bitorder="little").view("<u8"))
            sizes.append(bits)
            left = left[~alone]
        return cls(np.array(sizes), np.concatenate([np.zeros(0, np.uint64), *words]))

    def slots(self, keys: Keys) -> np.ndarray:
        """Slot of each key; -1 for some keys that were not in the build, any slot for others."""
        slots = np.full(len(keys.first), -1, dtype=np.int64)
        left, base = np.arange(len(slots)), 0
        for level, bits in enumerate(self.sizes):
            if not len(left):
                break
            at = keys.hashed(level, left) % bits
            word = self.words[base + (at >> np.uint64(6)).astype(np.int64)]
            bit = at & np.uint64(63)
            hit = (word >> bit) & np.uint64(1) == 1
            index = base + (at[hit] >> np.uint64(6)).astype(np.int64)
            lower = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            slots[left[hit]] = self.before[index] + np.bitwise_count(lower)
            left, base = left[~hit], base + int(bits) // 64
        return slots


def part_of(doc_id: int | None, occurrence: int, parts: int) -> int:
    """The same as Spark's ``pmod(xxhash64(doc_id, occurrence), parts)``."""
    seed = _SEED
    for value in (doc_id, occurrence):
        if value is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", value), seed=seed)
    return (seed - (1 << 64) if seed >> 63 else seed) % parts
