"""Passages that documents share, exactly or nearly, by chaining k-mer seeds and aligning the chains.

1. Seeds. Of a document's 5-word hashes those that are least in some window of WINDOW = 2 stay, so any exact run of 6
   words that two documents share gives both the same seed.
2. Matches. Each seed is tied to the first place of the smallest document that holds it, whatever the partitions are: a
   task's bundle sends on all places of its own first holder, to blocks of seeds, and keeps the other holders back as
   followers; a block finds the first of all, matches the bundles' first holders with it, and tells the bundles, which
   then match their followers with it too. A seed that very many documents hold is thus one document's entries for each
   bundle, and makes one match for each place that holds it, never a pair of any two.
3. Chains. The matches of a document with a source are merged along diagonals and chained in both orders; a chain's
   score is its seeds' less a cost for the words between them, and a Fenwick tree of prefix maxima finds the best
   predecessor. A chain ends where it leaves more than MAX_GAP words. Chains of one document that lie within 2 * REACH
   words of each other are a run; runs that could not reach min_words even with REACH words more at each end go.
4. Alignment. The two texts meet, the words between a chain's anchors are aligned, and both ends are extended through
   equal words, changed, added and missing ones alike, while equal ones prevail. Of the stretch so found the parts stay
   where an equal word counts 1 and any other one -UNEQUAL and that no cut would better; a part is a piece of the result if
   it alone, in either text, is min_words long. So a passage is one that a single source holds: what is made of short
   parts of several sources is none. Where a run has room for a passage beside its pieces, a document may still hold the
   whole of it that smaller ones, which hold its parts, hid. Such rooms (of REACH words or more, and min_words about them)
   go through the four steps once more, with all seeds of min_words words, so no exact passage is lost (an edited one,
   hidden so, is).

The first holder of a passage is its source and is named as such; every other holder has rows of its own. Pieces of a
document that overlap or touch form a passage.

Scale: shuffled are 6 bytes of hash for two words in three and their place, byte by byte (first bytes, second bytes ...)
so that those of documents and positions shrink to about two bytes; the matches, alike; the texts of documents with runs
and of their sources, and of the former the runs' words once more for each chain. A task holds one bundle, one block, or
one document's matches; blocks are sized by the bytes of all texts, not by the number of tasks. Hashes have 48 bits
beside the block's: chance ties cost an alignment, never a wrong row.

Edge cases: null and empty texts and texts under 5 words share nothing; rows without an id take part, those of equal texts
as one document behind all others, and are named null; rows of one id are searched as one document, never against each
other, so equal rows share nothing; very long texts are searched whole; extra columns are ignored; an empty table gives
an empty result. An extension goes through at most PAD words beyond the run, where no seed of any document stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwell.llm.common import partitions, quoted, small_batches, written
from dwell.llm.word_hash import ngram_hashes, words_of

K = 5
WINDOW = 2
MIN_WORDS = 50
MAX_GAP = 30
REACH = 14  # words beside a chain that may match though no seed shows it
PAD = 4 * REACH  # words beside a run that an extension may go through
GAP_COST = 0.2
UNEQUAL = 1.5  # what a word that is not equal costs against the 1 of an equal one
DROP = 8  # an extension ends when its score is so far below its best
BLOCK_BYTES = 16 << 20  # of text, at most, for each block of seeds or of documents
FLUSH = 1 << 19
BROADCAST_ROWS = 500_000
NO_ID = 1 << 62  # documents without an id are numbered from here on

BUNDLE_SQL = "kind int, block int, bundle long, a binary"
#: kinds of rows: matches for a block of documents, seeds for a block of seeds, followers and what a block tells of them for a bundle
MATCHES, SEEDS, FOLLOWERS, TOLD = range(4)
SEED = np.dtype([("gram", "<u8"), ("doc", "<i8"), ("pos", "<i4")])
MATCH = np.dtype([("doc", "<i8"), ("source", "<i8"), ("pos", "<i4"), ("at", "<i4")])
SEGMENT = np.dtype([("pos", "<i4"), ("at", "<i4"), ("size", "<i4"), ("chain", "<i4")])
#: The top bit of a seed's place: other documents of its bundle hold the seed too.
FOLLOWED = 1 << 30
GRAM_MASK = np.uint64((1 << 48) - 1)


def _least(h: np.ndarray, w: int, of=np.minimum) -> np.ndarray:
    """of over each window of w."""
    out, size = h, 1
    while size * 2 <= w:
        out, size = of(out[:-size], out[size:]), size * 2
    return of(out[: len(out) - (w - size)], out[w - size :]) if w > size else out


def minimizers(h: np.ndarray, w: int = WINDOW) -> np.ndarray:
    """Positions of hashes that are least in some window of w."""
    if len(h) <= w:
        return np.flatnonzero(h == h.min()) if len(h) else np.zeros(0, np.int64)
    least = _least(h, w)
    pad = np.zeros(w - 1, h.dtype)
    return np.flatnonzero(_least(np.concatenate([pad, least, pad]), w, np.maximum) == h)


def _planes(rows: np.ndarray, short: bool = False) -> bytes:
    """Rows in order of document and place, as the first bytes of all, the second bytes of all and so on; short leaves out
    the two high bytes of a hash."""
    rows = np.ascontiguousarray(rows[np.lexsort((rows["pos"], rows["doc"]))])
    planes = rows.view(np.uint8).reshape(-1, rows.dtype.itemsize).T
    return (np.delete(planes, (6, 7), axis=0) if short else planes).tobytes()


def _rows(planes: bytes, kind: np.dtype) -> np.ndarray:
    if kind == SEED:
        held = np.frombuffer(planes, np.uint8).reshape(kind.itemsize - 2, -1)
        whole = np.zeros((kind.itemsize, held.shape[1]), np.uint8)
        whole[:6], whole[8:] = held[:6], held[6:]
        return np.ascontiguousarray(whole.T).view(kind).ravel()
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def _batch(kind: int, blocks: list[int | None], bundles: list[int | None], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(data), pa.int32()), pa.array(blocks, pa.int32()), pa.array(bundles, pa.int64()), pa.array(data, pa.binary())], names=["kind", "block", "bundle", "a"])


def _bundled(rows: np.ndarray, block: np.ndarray, kind: int, bundle: int | None = None) -> Iterator[pa.RecordBatch]:
    order = np.argsort(block, kind="stable")
    rows, block = rows[order], block[order]
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
    part = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
    for i in range(0, len(part), 256):
        own = part[i : i + 256]
        yield _batch(kind, [int(block[a]) for a, _ in own], [bundle] * len(own), [_planes(rows[a:b], kind != MATCHES) for a, b in own])


def _ordered(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds in order of (gram, doc, pos), and for each the index of its gram's first."""
    seeds = seeds[np.lexsort((seeds["pos"], seeds["doc"], seeds["gram"]))]
    start = np.flatnonzero(np.concatenate([[True], seeds["gram"][1:] != seeds["gram"][:-1]])) if len(seeds) else np.zeros(0, np.int64)
    return seeds, np.repeat(start, np.diff(np.append(start, len(seeds))))


def _matches(doc: np.ndarray, pos: np.ndarray, source: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(doc), MATCH)
    out["doc"], out["pos"], out["source"], out["at"] = doc, pos, source, at
    return out


def _by(x: np.ndarray, n: int) -> np.ndarray:
    x = x.view(np.uint64) if x.dtype != np.uint64 else x
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).astype(np.int64) % n


def _inside(at: np.ndarray, ranges: bytes | None, k: int) -> np.ndarray:
    """Places of seeds whose words all lie in one of the ranges (first word and end, one after the other), or all places."""
    if ranges is None:
        return at
    edges = np.frombuffer(ranges, "<i8").reshape(-1, 2)
    return at[np.any([(at >= a) & (at + k <= b) for a, b in edges.tolist()], axis=0)]


def _seeded(n_blocks: int, k: int = K, window: int = WINDOW):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            seeds, first = _ordered(np.concatenate(held))
            other = seeds["doc"] != seeds["doc"][first]
            followed = np.zeros(len(seeds), bool)
            followed[first[other]] = True
            followed = followed[first]  # by gram
            if other.any():  # with the first holder's first place, which stands for all that the block may not tell
                kept = seeds[other | (followed & (np.arange(len(seeds)) == first))]
                yield _batch(FOLLOWERS, [None], [bundle], [_planes(kept, True)])
            firsts = seeds[~other]
            block = _by(firsts["gram"] >> np.uint64(16), n_blocks)
            firsts["pos"] |= np.where(followed[~other], FOLLOWED, 0).astype(np.int32)
            yield from _bundled(firsts, block, SEEDS, bundle)

        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for doc, ranges, (n, h) in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), ngram_hashes(texts, k)):
                if n >= k:
                    at = _inside(minimizers(h, window), ranges, k)
                    own = np.zeros(len(at), SEED)
                    own["gram"], own["doc"], own["pos"] = h[at] & GRAM_MASK, doc, at
                    held.append(own)
                    size += len(own)
                    if size >= FLUSH:
                        yield from flush()
                        held, size, bundle = [], 0, bundle + 1
        if size:
            yield from flush()

    return per_partition


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """Rows come ordered by the key: each key's (kind, bundle, data)."""
    now, held = None, []
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in (key, "kind", "bundle", "a")]
        for k, *row in zip(*cols):
            if k != now and held:
                yield now, held
                held = []
            now = k
            held.append(tuple(row))
    if held:
        yield now, held


def _met(n_blocks: int):
    """Blocks of seeds: matches of the bundles' first holders with the first of all, and for bundles with followers, that one."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            matches = np.concatenate(held)
            yield from _bundled(matches, _by(np.ascontiguousarray(matches["doc"]), n_blocks), MATCHES)

        for _, rows in _grouped(batches, "block"):
            parts = [_rows(a, SEED) for _, _, a in rows]
            bundle = np.repeat([b for _, b, _ in rows], [len(p) for p in parts])
            seeds = np.concatenate(parts)
            followed = seeds["pos"] & FOLLOWED != 0
            seeds["pos"] &= FOLLOWED - 1
            order = np.lexsort((seeds["pos"], seeds["doc"], seeds["gram"]))
            seeds, bundle, followed = seeds[order], bundle[order], followed[order]
            seeds, first = _ordered(seeds)  # in order already, so bundle and followed stay beside them
            other = seeds["doc"] != seeds["doc"][first]
            matches = _matches(seeds["doc"][other], seeds["pos"][other], seeds["doc"][first[other]], seeds["pos"][first[other]])
            if len(matches):
                held.append(matches)
                size += len(matches)
            tell = other & followed
            if tell.any():
                said, to = seeds[first[tell]], bundle[tell]
                once = np.unique(np.stack([to, said["gram"].view(np.int64)], axis=1), axis=0, return_index=True)[1]
                said, to = said[once], to[once]
                cuts = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), len(to)]
                for i in range(0, len(cuts) - 1, 256):
                    own = list(zip(cuts[i : i + 256], cuts[i + 1 : i + 257]))
                    yield _batch(TOLD, [None] * len(own), [int(to[a]) for a, _ in own], [_planes(said[a:b], True) for a, b in own])
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return per_partition


def _passed(inner):
    """Followers stand before the seeds of a partition and pass as they are; the rest goes to inner."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        for batch in batches:
            own = pc.equal(batch.column("kind"), FOLLOWERS)
            if pc.any(own).as_py():
                yield batch.filter(own)
            rest = batch.filter(pc.invert(own))
            if rest.num_rows:
                yield from inner(chain([rest], batches))

    return per_partition


def _followed(n_blocks: int):
    """Bundles: matches of the followers with the first of all, which is the bundle's own first holder where no block told another."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            matches = np.concatenate(held)
            yield from _bundled(matches, _by(np.ascontiguousarray(matches["doc"]), n_blocks), MATCHES)

        for _, rows in _grouped(batches, "bundle"):
            seeds, first = _ordered(np.concatenate([_rows(a, SEED) for k, _, a in rows if k == FOLLOWERS]))
            told = [_rows(a, SEED) for k, _, a in rows if k == TOLD]
            source, at = seeds["doc"][first].copy(), seeds["pos"][first].copy()
            if told:
                told = np.concatenate(told)
                told = told[np.argsort(told["gram"])]
                k = np.minimum(np.searchsorted(told["gram"], seeds["gram"]), len(told) - 1)
                hit = told["gram"][k] == seeds["gram"]
                source[hit], at[hit] = told["doc"][k[hit]], told["pos"][k[hit]]
            other = seeds["doc"] != seeds["doc"][first]  # the first holder's own places are matched in the block
            held.append(_matches(seeds["doc"][other], seeds["pos"][other], source[other], at[other]))
            size += len(held[-1])
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return per_partition


def segments(pos: np.ndarray, at: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches of one pair, merged along diagonals: (pos, at, size in words, seeds)."""
    order = np.lexsort((pos, pos - at))
    pos, at = pos[order], at[order]
    new = np.ones(len(pos), bool)
    new[1:] = (np.diff(pos - at) != 0) | (np.diff(pos) > MAX_GAP + k)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(pos)) - 1
    return pos[start], at[start], pos[end] - pos[start] + k, end - start + 1


class Fenwick:
    """Prefix maxima of (value, index)."""

    def __init__(self, n: int):
        self.best = [(-1e300, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def below(self, i: int) -> tuple[float, int]:
        found = (-1e300, -1)
        while i > 0:
            if self.best[i] > found:
                found = self.best[i]
            i -= i & -i
        return found


def chains(pos: np.ndarray, at: np.ndarray, size: np.ndarray, seeds: np.ndarray, k: int = K) -> list[list[int]]:
    """Segments to chains, best first; each segment is in one chain at most.

    score(i) = weight(i) + max(0, max over j that end before i begins, in both texts, of score(j) - cost of the words
    between). The cost is linear in both distances, so each j has one key and a prefix maximum by its end decides.
    """
    n = len(pos)
    if n == 1:
        return [[0]]
    weight = np.minimum(size, seeds * k).astype(float).tolist()
    p, q = pos.tolist(), at.tolist()
    pe, qe = (pos + size).tolist(), (at + size).tolist()
    ends = sorted(set(qe))
    rank = {e: i for i, e in enumerate(ends)}
    tree, score, before = Fenwick(len(ends)), [0.0] * n, [-1] * n
    starts = sorted(range(n), key=lambda i: p[i])
    closing = sorted(range(n), key=lambda i: pe[i])
    done = 0
    slots = np.searchsorted(ends, q, side="right").tolist()
    for i in starts:
        while done < n and pe[closing[done]] <= p[i]:
            j = closing[done]
            tree.put(rank[qe[j]], (score[j] + GAP_COST * (pe[j] + qe[j]), j))
            done += 1
        value, j = tree.below(slots[i])
        gain = value - GAP_COST * (p[i] + q[i])
        score[i] = weight[i] + max(0.0, gain)
        before[i] = j if gain > 0 else -1
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        own = []
        while i >= 0 and not used[i]:
            used[i] = True
            own.append(i)
            i = before[i]
        if own:
            out.append(own[::-1])
    return out


def pieces(pos: np.ndarray, at: np.ndarray, k: int = K) -> np.ndarray:
    """Matches of one pair to segments numbered by chain; chains are cut where they leave more than MAX_GAP words."""
    p, q, size, seeds = segments(pos, at, k)
    out: list[tuple[int, int, int, int]] = []
    number = 0
    for own in chains(p, q, size, seeds, k):
        for nth, i in enumerate(own):
            if nth and max(p[i] - out[-1][0] - out[-1][2], q[i] - out[-1][1] - out[-1][2]) > MAX_GAP:
                number += 1
            out.append((int(p[i]), int(q[i]), int(size[i]), number))
        number += 1
    return np.array(out, SEGMENT)


def runs_of(spans: list[tuple[int, int]], min_words: int) -> list[tuple[int, int, list[int]]]:
    """(first word, end, spans) of the runs that may hold a passage. Spans that lie within another one of min_words add
    nothing to it and are left out."""
    order = sorted(range(len(spans)), key=lambda i: (spans[i][0], -spans[i][1]))
    out, i = [], 0
    while i < len(order):
        first, end = spans[order[i]]
        run: list[int] = []
        covered = -1  # as far as a span of min_words reaches
        while i < len(order) and spans[order[i]][0] - REACH <= end + REACH:
            a, b = spans[order[i]]
            if b > covered:
                run.append(order[i])
            if b - a >= min_words:
                covered = max(covered, b)
            end = max(end, b)
            i += 1
        if end - first + 2 * REACH >= min_words:
            out.append((first, end, run))
    return out


CHAINED_SQL = "doc long, source long, run long, run_end long, segments binary"


def _chained(min_words: int, k: int = K):
    """The chains that may be min_words long with REACH words more at each end, and, without a source, the runs that have room
    for a passage."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _grouped(batches, "block"):
            matches = np.concatenate([_rows(a, MATCH) for _, _, a in blobs])
            matches = matches[np.lexsort((matches["pos"], matches["source"], matches["doc"]))]
            doc, source = matches["doc"], matches["source"]
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])])
            cuts = np.append(np.flatnonzero(new), len(matches)).tolist()
            rows: list[tuple] = []
            own: list[tuple[int, int, np.ndarray]] = []

            def close():
                spans, of = [], []
                for nth, (_, _, s) in enumerate(own):
                    starts = np.flatnonzero(np.concatenate([[True], s["chain"][1:] != s["chain"][:-1]]))
                    least, most = np.minimum.reduceat(s["pos"], starts), np.maximum.reduceat(s["pos"] + s["size"], starts)
                    spans += zip(least.tolist(), most.tolist())
                    of += [(nth, c) for c in s["chain"][starts].tolist()]
                for first, end, run in runs_of(spans, min_words):
                    kept: dict[int, list[int]] = {}
                    for i in run:
                        if spans[i][1] - spans[i][0] + 2 * REACH >= min_words:
                            kept.setdefault(of[i][0], []).append(of[i][1])
                    if end - first >= min_words - 2 * WINDOW:  # an exact passage shows seeds over all its words but these
                        rows.append((own[0][0], None, first, end, None))
                    rows.extend((own[i][0], own[i][1], first, end, own[i][2][np.isin(own[i][2]["chain"], chosen)].tobytes()) for i, chosen in kept.items())
                own.clear()

            for a, b in zip(cuts, cuts[1:]):
                if own and own[-1][0] != doc[a]:
                    close()
                own.append((int(doc[a]), int(source[a]), pieces(matches["pos"][a:b].astype(np.int64), matches["at"][a:b].astype(np.int64), k)))
            if own:
                close()
            for i in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 4096]), (pa.int64(),) * 4 + (pa.binary(),))], names=["doc", "source", "run", "run_end", "segments"])

    return per_partition


def equal_in_gap(x: list[bytes], y: list[bytes]) -> int:
    """Words of the longest common subsequence of two short lists."""
    if not x or not y:
        return 0
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            old = row[j]
            row[j] = last + 1 if a == b else max(row[j], row[j - 1])
            last = old
    return row[-1]


def blocks_of(x: list[bytes], y: list[bytes], p: list[int], q: list[int], size: list[int]) -> list[tuple[int, int, int, int, int]]:
    """A chain as stretches (start, end, start in y, end in y, equal words): runs of K equal words or more, and what lies between."""
    out: list[tuple[int, int, int, int, int]] = []
    i, j = p[0], q[0]

    def gap(a: int, b: int) -> None:
        nonlocal i, j
        if a > i or b > j:
            out.append((i, a, j, b, equal_in_gap(x[i:a], y[j:b])))
        i, j = a, b

    for a, b, n in zip(p, q, size):
        k = 0
        while k < n:
            start = k
            while k < n and x[a + k] == y[b + k]:
                k += 1
            if k - start >= K:
                gap(a + start, b + start)
                out.append((a + start, a + k, b + start, b + k, k - start))
                i, j = a + k, b + k
            k += k == start
    return out


def extended(x: list[bytes], y: list[bytes], i: int, j: int, step: int) -> tuple[int, int, int]:
    """How far two texts agree from (i, j) on in the direction of step: words of x, words of y, equal ones. Furthest points
    by diagonal for each number of changed, added or missing words; those that fall DROP below the best score go."""
    n, m = (len(x) - i, len(y) - j) if step > 0 else (i + 1, j + 1)
    best, found = 0.0, (0, 0, 0)
    front = {0: (0, 0)}  # diagonal: words of x, equal ones
    edits = 0
    while front:
        reached: dict[int, tuple[int, int]] = {}
        for d, (a, e) in front.items():
            b = a - d
            while a < n and b < m and x[i + step * a] == y[j + step * b]:
                a, b, e = a + 1, b + 1, e + 1
            score = e - UNEQUAL * edits
            if score > best:
                best, found = score, (a, b, e)
            if score >= best - DROP:
                reached[d] = (a, e)
        edits += 1
        front = {}
        for d, (a, e) in reached.items():
            b = a - d
            for dd, aa, bb in ((d, a + 1, b + 1), (d + 1, a + 1, b), (d - 1, a, b + 1)):
                if aa <= n and bb <= m and e - UNEQUAL * edits >= best - DROP and ((aa, e) > front.get(dd, (-1, -1))):
                    front[dd] = (aa, e)
    return found


def best_parts(stretches: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """All maximal parts of a row of stretches, by score: an equal word counts 1, any other -UNEQUAL (Ruzzo and Tompa)."""
    parts: list[tuple[float, float, int, int]] = []  # score before, score after, first and last stretch
    total = 0.0
    for k, (a, b, c, d, equal) in enumerate(stretches):
        score = equal - UNEQUAL * (max(b - a, d - c) - equal)
        if score <= 0:
            total += score
            continue
        left, right, first = total, total + score, k
        total = right
        while True:
            at = next((z for z in range(len(parts) - 1, -1, -1) if parts[z][0] < left), None)
            if at is None or parts[at][1] >= right:
                parts.append((left, right, first, k))
                break
            left, first = parts[at][0], parts[at][2]
            del parts[at:]
    return [(stretches[f][0], stretches[t][1], stretches[f][2], stretches[t][3], sum(s[4] for s in stretches[f : t + 1])) for _, _, f, t in parts]


def aligned(x: list[bytes], y: list[bytes], parts: np.ndarray, min_words: int = 2 * K) -> list[tuple[int, int, int, int, int]]:
    """(start, end, source start, source end, equal words) of each piece of min_words or more."""
    out: list[tuple[int, int, int, int, int]] = []
    parts = parts[np.lexsort((parts["pos"], parts["chain"]))]
    cuts = np.append(np.flatnonzero(np.concatenate([[True], parts["chain"][1:] != parts["chain"][:-1]])), len(parts)).tolist()
    ranges = [(int(parts["pos"][b - 1] + parts["size"][b - 1] - parts["pos"][a]), a, b) for a, b in zip(cuts, cuts[1:])]
    for _, a, b in sorted(ranges, key=lambda r: (-r[0], r[1])):  # a long one's extension holds short ones, which then are done
        p, q, size = parts["pos"][a:b].tolist(), parts["at"][a:b].tolist(), parts["size"][a:b].tolist()
        end, at = p[-1] + size[-1], q[-1] + size[-1]
        if end > len(x) or at > len(y) or any(f[0] <= p[0] and end <= f[1] and f[2] <= q[0] and at <= f[3] for f in out):
            continue  # beyond the end: another row of this id holds it
        middle = blocks_of(x, y, p, q, size)
        if not middle:
            continue  # a chance tie of hashes, or another row of this id
        n, m, e = extended(x, y, middle[0][0] - 1, middle[0][2] - 1, -1)
        left = [(middle[0][0] - n, middle[0][0], middle[0][2] - m, middle[0][2], e)] if n else []
        n, m, e = extended(x, y, middle[-1][1], middle[-1][3], 1)
        right = [(middle[-1][1], middle[-1][1] + n, middle[-1][3], middle[-1][3] + m, e)] if n else []
        out += [s for s in best_parts(left + middle + right) if max(s[1] - s[0], s[3] - s[2]) >= min_words and s not in out]
    return sorted(out)


SLICED_SQL = "doc long, source long, run long, run_end long, segments binary, first long, doc_id long, doc_text binary"


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the texts only the words about the runs go on to meet their sources; positions then count from first."""
    last: tuple[bytes, list[bytes]] = (b"", [])
    for batch in batches:
        firsts, slices, parts = [], [], []
        for raw, data, run, end in zip(batch.column("doc_text").cast(pa.binary()), batch.column("segments"), batch.column("run").to_pylist(), batch.column("run_end").to_pylist()):
            if (text := raw.as_py()) != last[0]:
                last = (text, words_of(text))
            own = np.frombuffer(data.as_py(), SEGMENT).copy()
            first = max(0, run - PAD)
            slices.append(b" ".join(last[1][first : end + PAD]))
            own["pos"] -= first
            firsts.append(first)
            parts.append(own.tobytes())
        cols = [batch.column(c) for c in ("doc", "source", "run", "run_end")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(parts, pa.binary()), pa.array(firsts, pa.int64()), batch.column("doc_id"), pa.array(slices, pa.binary())], names=["doc", "source", "run", "run_end", "segments", "first", "doc_id", "doc_text"])


ALIGNED = ("doc", "run", "run_end", "source", "doc_id", "start", "end", "source_doc_id", "source_start", "source_end", "n_equal")


def _aligned(min_words: int):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, list[bytes]] = (b"", [])
        for batch in batches:
            rows: list[tuple] = []
            cols = {n: batch.column(n).to_pylist() for n in ("doc", "source", "run", "run_end", "first", "doc_id", "source_doc_id")}
            texts = [batch.column(n).cast(pa.binary()) for n in ("doc_text", "source_text")]
            for i, (doc, source, run, end, first, doc_id, source_id) in enumerate(zip(*cols.values())):
                raw = texts[1][i].as_py()
                if raw != last[0]:
                    last = (raw, words_of(raw))
                found = aligned(words_of(texts[0][i].as_py()), last[1], np.frombuffer(batch.column("segments")[i].as_py(), SEGMENT), min_words)
                rows += [(doc, run, end, source, doc_id, a + first, b + first, source_id, c, d, e) for a, b, c, d, e in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=list(ALIGNED))

    return per_partition


def _round(texts: DataFrame, size: int, min_words: int, k: int = K, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """texts: doc, doc_id, text, ranges (where its seeds may stand; null: anywhere). All pieces, and the rooms of runs beside
    them: doc, gaps."""
    n_blocks = max(partitions(texts.sparkSession), -(-size // BLOCK_BYTES))
    n = max(partitions(texts.sparkSession), n_blocks // 16)
    dealt = lambda df, key: (df.repartitionById(n, key) if key == "block" else df.repartition(n, key)).sortWithinPartitions(key)
    seeds = texts.select("doc", "text", "ranges").mapInArrow(_seeded(n_blocks, k, window), BUNDLE_SQL)
    slot = F.coalesce("block", F.lit(-1) - F.pmod(F.xxhash64("bundle"), F.lit(n_blocks)).cast("int"))
    met = written(dealt(seeds.withColumn("block", slot), "block").mapInArrow(_passed(_met(n_blocks)), BUNDLE_SQL), "matches")
    late = dealt(met.where(F.col("kind").isin(FOLLOWERS, TOLD)), "bundle").mapInArrow(_followed(n_blocks), BUNDLE_SQL)
    matches = met.where(F.col("kind") == MATCHES).unionByName(late)
    found = written(dealt(matches, "block").mapInArrow(_chained(min_words, k), CHAINED_SQL), "chains")
    runs, found = found.where("source is null"), found.where("source is not null")

    wanted = written(found.select(F.explode(F.array("doc", "source")).alias("doc")).distinct(), "wanted")
    few = wanted.count() <= BROADCAST_ROWS
    chosen = texts.join(F.broadcast(wanted) if few else wanted, "doc", "left_semi")
    left = found.join(chosen.select("doc", "doc_id", F.col("text").alias("doc_text")), "doc")
    left = left.select("doc", "source", "run", "run_end", "segments", "doc_id", "doc_text").mapInArrow(_sliced, SLICED_SQL)
    both = left.join(chosen.select(F.col("doc").alias("source"), F.col("doc_id").alias("source_doc_id"), F.col("text").alias("source_text")), "source")
    both = both.select("doc", "source", "run", "run_end", "segments", "first", "doc_id", "doc_text", "source_doc_id", "source_text")
    spans = written(both.mapInArrow(_aligned(min_words), ", ".join(f"`{c}` long" for c in ALIGNED)).distinct(), "aligned")

    run = spans.select("doc", "run", "run_end", "start", "end").unionByName(runs.select("doc", "run", "run_end"), allowMissingColumns=True)
    run = run.groupBy("doc", "run", "run_end").agg(F.array_sort(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "end")))).alias("pieces"))
    gap = F.aggregate(
        F.concat("pieces", F.array(F.struct(F.col("run_end").alias("start"), F.col("run_end").alias("end")))),
        F.struct(F.col("run").alias("reach"), F.array().cast("array<struct<start:long,end:long>>").alias("gaps")),
        lambda s, p: F.struct(F.greatest(s["reach"], p["end"]).alias("reach"), F.when(p["start"] - s["reach"] >= REACH, F.array_append(s["gaps"], F.struct((s["reach"] - min_words).alias("start"), (p["start"] + min_words).alias("end")))).otherwise(s["gaps"]).alias("gaps")),
        lambda s: s["gaps"],
    )
    left_over = run.select("doc", F.explode(gap).alias("g")).select("doc", "g.start", "g.end").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gaps"))
    return spans, left_over


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, start, end, source_doc_id, source_start, source_end, n_equal, passage_start, passage_end: positions in words,
    ends exclusive. One row for each piece of min_words or more that a source holds."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text")).where("text is not null")
    texts = texts.select(_number(F.col("doc_id"), F.col("text")).alias("doc"), "doc_id", "text")
    length = lambda df: df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spans, rooms = _round(texts.withColumn("ranges", F.lit(None).cast("binary")), length(texts), min_words)
    rooms = written(rooms.mapInArrow(_ranged, "doc long, ranges binary"), "rooms")
    n = rooms.count()
    if n > 1 and min_words > K:
        narrow = written(texts.join(F.broadcast(rooms) if n <= BROADCAST_ROWS else rooms, "doc"), "room-texts")
        spans = spans.unionByName(_round(narrow, length(narrow), min_words, min_words, 1)[0])

    order = Window.partitionBy("doc").orderBy("start", "end", "source", "source_start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = spans.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("k", F.sum("new").over(order))
    whole = Window.partitionBy("doc", "k")
    out = numbered.withColumn("passage_start", F.min("start").over(whole)).withColumn("passage_end", F.max("end").over(whole))
    return out.select("doc_id", "start", "end", "source_doc_id", "source_start", "source_end", "n_equal", "passage_start", "passage_end")


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [np.array([(g["start"], g["end"]) for g in gaps], "<i8").tobytes() for gaps in batch.column("gaps").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(data, pa.binary())], names=["doc", "ranges"])


def _number(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id, F.lit(NO_ID) + F.pmod(F.xxhash64(text), F.lit(NO_ID - 1)))
