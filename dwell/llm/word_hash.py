"""64-bit hashes of all word n-grams of many texts at once, with numpy.

Words are what ASCII white space separates, A-Z lower-cased. A text becomes its words joined by one space; the hash of
a byte range is a polynomial over table entries, taken from prefix sums modulo 2 ** 64 and then mixed, so it depends on
the bytes alone and not on where they stand. Texts are worked on in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from dwell.llm.mph import mixed

PIECE_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = mixed(np.arange(256, dtype=np.uint64), 77)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n of each."""
    if len(_powers[0]) < n:
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _hashed(piece: list[list[bytes]], k: int) -> list[np.ndarray]:
    """For each list of words the hashes of its k-grams in order; of a shorter one the hash of all its words."""
    full = [w for w in piece if w]
    if not full:
        return [np.zeros(0, np.uint64) for _ in piece]
    data = b" ".join([b" ".join(w) for w in full])
    raw = np.frombuffer(data, np.uint8)
    up, down = _grown(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * up[: len(raw)], out=sums[1:])
    ends = np.append(np.flatnonzero(raw == 32), len(raw))
    starts = np.concatenate([[0], ends[:-1] + 1])
    n_words = np.array([len(w) for w in full])
    first = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    n_grams = np.maximum(n_words - k + 1, 1)
    lead = np.repeat(first - np.concatenate([[0], np.cumsum(n_grams)[:-1]]), n_grams) + np.arange(n_grams.sum())
    last = np.minimum(lead + k - 1, np.repeat(first + n_words - 1, n_grams))
    a, b = starts[lead], ends[last]
    values = mixed((sums[b] - sums[a]) * down[a], 5)
    cuts = np.cumsum(n_grams)
    parts = iter(np.split(values, cuts[:-1]))
    return [next(parts) if w else np.zeros(0, np.uint64) for w in piece]


def ngram_hashes(texts: list[bytes], k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, hashes of the k-grams in order) for each text."""
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        if len(text) > PIECE_BYTES:
            yield from ((len(w), h) for w, h in zip(held, _hashed(held, k)))
            held, size = [], 0
            words = words_of(text)
            yield len(words), _long(words, k)
            continue
        held.append(words_of(text))
        size += len(text)
        if size > PIECE_BYTES:
            yield from ((len(w), h) for w, h in zip(held, _hashed(held, k)))
            held, size = [], 0
    yield from ((len(w), h) for w, h in zip(held, _hashed(held, k)))


def _long(words: list[bytes], k: int) -> np.ndarray:
    """Pieces of a long text overlap by k - 1 words."""
    if len(words) < k:
        return _hashed([words], k)[0]
    out, start, size = [], 0, 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if size > PIECE_BYTES and i - start >= k:
            out.append(_hashed([words[start : i + 1]], k)[0])
            start, size = i + 2 - k, 0
    if len(words) - start >= k:
        out.append(_hashed([words[start:]], k)[0])
    return np.concatenate(out)
