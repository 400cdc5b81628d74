"""A minimal perfect hash over 128-bit keys, and shards of arrays indexed by it.

Levels of bit arrays, each about gamma bits for every key still unplaced: a key that alone hits its bit is placed
there, the rest go on to the next level. A key's slot is the number of set bits before its own, so n keys fill slots
0..n-1 without gaps. Keys outside the set get some slot or none; what a slot stores tells them apart.
"""

from __future__ import annotations

import io

import numpy as np

GAMMA = 2.0
MAX_LEVELS = 48


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over uint64, other for every seed."""
    x = x ^ np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key64(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return mixed(hi, 101) ^ mixed(lo, 202)


class PerfectHash:
    def __init__(self, sizes: np.ndarray, words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = sizes, words, rest
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    def __len__(self) -> int:
        return int(self.before[-1]) + len(self.rest)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct uint64. Those that no level places (in practice none) are kept sorted, with the last slots."""
        sizes, parts, left = [], [], np.asarray(keys, np.uint64)
        for level in range(MAX_LEVELS):
            if not len(left):
                break
            m = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
            at = (mixed(left, level) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(m)
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1 for keys that certainly are not in the set."""
        keys = np.asarray(keys, np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_, start = np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes.tolist()):
            if not len(open_):
                return out
            at = (mixed(keys[open_], level) % np.uint64(m)).astype(np.int64)
            word, bit = self.words[start + (at >> 6)], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = (self.before[start + (at >> 6)] + below)[hit]
            open_, start = open_[~hit], start + m // 64
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = int(self.before[-1]) + at[hit]
        return out


def to_bytes(hash_: PerfectHash, **arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, sizes=hash_.sizes, words=hash_.words, rest=hash_.rest, **arrays)
    return out.getvalue()


def from_bytes(data: bytes) -> tuple[PerfectHash, dict[str, np.ndarray]]:
    with np.load(io.BytesIO(data), allow_pickle=False) as z:
        arrays = {k: z[k] for k in z.files}
    return PerfectHash(arrays.pop("sizes"), arrays.pop("words"), arrays.pop("rest")), arrays
