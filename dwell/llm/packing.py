"""Packing token sequences into windows by non-negative least squares over shallow length combinations.

Each task tokenises its documents and cuts them: whole windows stand alone, what is left of a document is one piece
shorter than a window. Pieces gather into a pool. When the pool is large enough, its histogram of lengths (in classes
of window / CLASSES tokens) is matched by combinations of up to DEPTH classes that together fill a window: repeat
counts x >= 0 with least |A x - histogram|^2, rounded down, never more than the pool holds. The combinations are then
made from the pool, longest pieces first. The residual pieces fill what room the combinations left and otherwise new
windows, greedily; a piece may be cut there, so every window but the last of a task is full. The last is cut into
lengths that are powers of two, which need no padding.

Scale: no shuffle; a task holds one pool of at most POOL_PIECES pieces (and one document). Sequence ids carry the
partition number, so they are unique without coordination.

Edge cases: a null or empty text is the end id alone; equal rows are packed each for itself; input columns other than
the id are not carried; ids may repeat or be null; an empty table gives an empty result. Text that spells a special
token is read as that token, as the tokenizer does by default.
"""

from __future__ import annotations

import os
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwell.llm.common import quoted, small_batches

WINDOW = 2048
CLASSES = 32
DEPTH = 3
POOL_PIECES = 4096
END_ID = 1
CACHE_WORDS = 400_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordTokens:
    """ids of a text, through a cache of words: the tokenizer treats what white space separates on its own.

    The cache has two generations of bounded size, so frequent words stay. A word of plain letters is one unit of the
    tokenizer, so many new ones can be encoded as a single text, and the ids of word ends tell them apart.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.cache_words, self.new, self.old = cache_words, {}, {}

    def _encode(self, words: list[str]) -> None:
        plain = [w for w in words if w.isascii() and w.isalpha()]
        if plain:
            ids = np.array(self.tokenizer.encode(" ".join(plain), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(plain):
                data, start = ids.tobytes(), 0
                for word, end in zip(plain, (cuts * 4).tolist()):
                    self.new[word] = data[start:end]
                    start = end
        rest = [w for w in words if w not in self.new]
        for word, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.new[word] = np.array(e.ids, "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        if len(self.new) > self.cache_words:
            self.old, self.new = self.new, {}
        missing, parts = [], {}
        for word in words:
            if (known := self.old.get(word)) is not None:
                self.new[word] = known
                continue
            low = word.lower() if word.isascii() else word
            stem = low[:-1] if low and low[-1] in ".,!" else low
            # letters, then one mark: two units for the tokenizer
            if stem and stem.isascii() and stem.isalpha():
                parts[word] = (stem, low[len(stem) :])
            else:
                missing.append(word)
        stems = {p for pair in parts.values() for p in pair if p}
        for s in [s for s in stems if s in self.old]:
            self.new[s] = self.old[s]
        self._encode([w for w in dict.fromkeys([*stems, *missing]) if w not in self.new])
        for word, (stem, mark) in parts.items():
            if word != stem:
                self.new[word] = self.new[stem] + (self.new[mark] if mark else b"")

    def __call__(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        known = self.new
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            self._learn({w for w in words if w not in known})
            known = self.new
            if any(w not in known for w in words):  # the generation changed on the way
                self._learn({w for w in words if w not in known})
            return b"".join([self.new[w] for w in words])


_tokens: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    if path not in _tokens:
        _tokens.clear()
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def combinations(classes: int = CLASSES, depth: int = DEPTH) -> np.ndarray:
    """Rows of counts by class (index c: lengths up to (c + 1) / classes of a window); each row's classes fill a window."""
    found: list[list[int]] = []

    def extend(head: list[int], room: int) -> None:
        if not room:
            found.append(head)
        elif len(head) < depth:
            for c in range(min(room, head[-1] if head else classes), 0, -1):
                extend([*head, c], room - c)

    extend([], classes)
    rows = np.zeros((len(found), classes))
    for i, combo in enumerate(found):
        for c in combo:
            rows[i, c - 1] += 1
    return rows


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 with least |a x - b|, by Lawson and Hanson's active sets."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    gradient = a.T @ b
    for _ in range(rounds):
        open_ = ~free & (gradient > 1e-8)
        if not open_.any():
            break
        free[np.argmax(np.where(open_, gradient, -np.inf))] = True
        while True:
            s = np.zeros(n)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if not free.any() or s[free].min() > 0:
                break
            low = free & (s <= 0)
            step = np.min(x[low] / np.maximum(x[low] - s[low], 1e-300))
            x += step * (s - x)
            free &= x > 1e-12
            x[~free] = 0
        x = s
        gradient = a.T @ (b - a @ x)
    return x


class Packer:
    """Pieces in, (piece, sequence, offset) out. A piece: (document, start, length)."""

    def __init__(self, first_sequence: int, window: int = WINDOW, classes: int = CLASSES, depth: int = DEPTH):
        self.window, self.classes, self.next = window, classes, first_sequence
        self.step = window // classes
        self.combos = combinations(classes, depth)
        self.open: list[tuple[int, int, int]] = []  # the pieces of the window that is being filled
        self.filled = 0

    def sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def whole(self, doc: int, start: int):
        return (doc, start, self.window, self.sequence(), 0)

    def pack(self, pool: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
        by_class: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for piece in sorted(pool, key=lambda p: p[2]):
            by_class[-(-piece[2] // self.step) - 1].append(piece)
        left = np.array([len(by_class[c]) for c in range(self.classes)], np.int64)
        repeats = np.floor(nnls(self.combos.T, left.astype(float)) + 1e-9).astype(np.int64)
        made: list[list[tuple[int, int, int]]] = []
        for i in np.argsort(-repeats, kind="stable"):
            need = self.combos[i].astype(np.int64)
            k = min([int(repeats[i]), *(left[need > 0] // need[need > 0]).tolist()])
            left -= k * need
            made += [[by_class[c].pop() for c in np.flatnonzero(need) for _ in range(need[c])] for _ in range(k)]
        residual = deque(p for c in range(self.classes) for p in by_class[c])  # the shortest first
        room = sum(p[2] for p in residual)
        for pieces in made:
            if (gap := self.window - sum(p[2] for p in pieces)) > room:  # nothing to fill it: take the combination apart
                residual.extend(pieces)
                room += self.window - gap
                continue
            room -= gap
            sequence, at = self.sequence(), 0
            for p in pieces:
                yield (*p, sequence, at)
                at += p[2]
            while at < self.window:
                doc, start, length = residual.popleft()
                take = min(length, self.window - at)
                yield (doc, start, take, sequence, at)
                at += take
                if take < length:
                    residual.appendleft((doc, start + take, length - take))
        yield from self.greedy(sorted(residual, key=lambda p: -p[2]))

    def greedy(self, pieces: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
        for doc, start, length in pieces:
            while length:
                take = min(length, self.window - self.filled)
                self.open.append((doc, start, take))
                self.filled += take
                start, length = start + take, length - take
                if self.filled == self.window:
                    yield from self._close(self.window)

    def _close(self, size: int) -> Iterator[tuple[int, int, int, int, int]]:
        """A sequence of the first size tokens of the open window."""
        sequence, at = self.sequence(), 0
        while at < size:
            doc, start, length = self.open.pop(0)
            take = min(length, size - at)
            yield (doc, start, take, sequence, at)
            at += take
            if take < length:
                self.open.insert(0, (doc, start + take, length - take))
        self.filled -= size

    def finish(self) -> Iterator[tuple[int, int, int, int, int]]:
        while self.filled:
            yield from self._close(1 << (self.filled.bit_length() - 1))


def _packed(path: str, window: int):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        packer = Packer(TaskContext.get().partitionId() << 40, window)
        held: dict[int, tuple[int | None, bytes]] = {}  # by a running number, as ids may repeat
        rows: list[tuple] = []
        pool: list[tuple[int, int, int]] = []
        n_docs = 0
        kind = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

        def batch() -> pa.RecordBatch:
            out = [(held[d][0], s, n, held[d][1][4 * s : 4 * (s + n)], len(held[d][1]) // 4, q, at) for d, s, n, q, at in rows]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)

        def drain() -> Iterator[pa.RecordBatch]:
            rows.extend(packer.pack(pool))
            pool.clear()
            if rows:
                yield batch()
            waiting = {p[0] for p in packer.open}
            for d in [d for d in held if d not in waiting]:
                del held[d]

        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = tokens(text or "") + end
                n = len(data) // 4
                held[n_docs] = (doc_id, data)
                whole = n // window * window
                rows.extend(packer.whole(n_docs, s) for s in range(0, whole, window))
                if whole < n:
                    pool.append((n_docs, whole, n - whole))
                n_docs += 1
                if len(pool) >= POOL_PIECES or len(rows) >= 2048:
                    yield from drain()
        yield from drain()
        rows.extend(packer.finish())
        if rows:
            yield batch()

    return per_partition


def packing(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset."""
    if window & (window - 1) or window < CLASSES:
        raise ValueError(f"window must be a power of two of at least {CLASSES}")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    return rows.mapInArrow(_packed(tokenizer_path, window), SCHEMA)
