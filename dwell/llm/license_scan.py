"""Licence notices in texts, by patience alignment with templates.

Words are lower-cased and stripped of punctuation at their ends. A template's telling words are those outside a list of
function words; coverage of MIN_COVERAGE cannot come about without one of them, so a place in a text is looked at only
around such a word. The window begins as many words before the first one found as may then stand there: those of the
template before its last telling word that coverage lets be first, and SLACK for words put in between. It ends where the
template, so begun, would end, with SLACK. Only windows that hold enough of the template's words at all, counted as the
window slides, are aligned: equal words at both ends first, then the words that are unique to both sides are
anchors, of which the longest increasing subsequence stays, and the gaps between anchors are aligned in the same way;
gaps without anchors fall back on the longest common subsequence. Coverage is the share of the template's words that
are aligned; the words that tell a licence from its siblings (TELLING) must be among them. Where found places overlap,
the one with more aligned words wins. What stands behind SPDX-License-Identifier is given in identifier.

Scale: one pass over the texts without a shuffle; the templates are a few kilobytes. Nothing is collected.

Edge cases: null and empty texts have no notice; several notices of a text, also of one kind, are rows of their own;
equal rows give equal rows; ids may be null or repeat; very long texts are scanned whole; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwell.llm.common import quoted, small_batches
from dwell.llm.license_templates import SIBLINGS, TELLING, TEMPLATES

MIN_COVERAGE = 0.8
SLACK = 1.5  # a window's words for one of the template
EDGES = b".,;:!?()[]{}<>\"'`*#/\\|-_=+~"
#: Function words, which no search starts from.
FUNCTION_WORDS = frozenset(b"a all an and any are as at be by can for free from if in is it may no not of on or that the this to under use was with you".split())
SCHEMA = "doc_id long, license_id string, start long, end long, n_aligned long, coverage double, identifier string"


def words_of(text: bytes) -> list[bytes]:
    """Words as compared; those that are punctuation alone stay as empty strings, so positions are those of the text."""
    return [w.strip(EDGES) for w in text.lower().split()]


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[bytes, ...]
    telling: frozenset[bytes]
    lead: int  # words that may stand before the first telling one that is still there
    phrases: tuple[tuple[bytes, ...], ...] = ()  # what tells it from its siblings: all of these must be aligned

    @classmethod
    def of(cls, name: str, text: str) -> Template:
        words = tuple(w for w in words_of(text.encode()) if w)
        telling = frozenset(w for w in words if w not in FUNCTION_WORDS)
        n = sum(w in telling for w in words)
        if len(words) - n >= math.ceil(MIN_COVERAGE * len(words)):
            raise ValueError(f"{name} has too few telling words")
        # at most this many words are missing or changed, so one of the first gone + 1 telling words is there
        gone = len(words) - math.ceil(MIN_COVERAGE * len(words))
        lead = [i for i, w in enumerate(words) if w in telling][: gone + 1][-1]
        return cls(name, words, telling, lead, tuple(tuple(words_of(p.encode())) for p in TELLING.get(name, ()) if _within(tuple(words_of(p.encode())), words)))

    def told(self, pairs: list[tuple[int, int]]) -> bool:
        """Whether each phrase is aligned somewhere, word after word."""
        at = {j: i for i, j in pairs}
        for p in self.phrases:
            starts = (j for j in range(len(self.words) - len(p) + 1) if self.words[j : j + len(p)] == p)
            if not any(j in at and all(at.get(j + k) == at[j] + k for k in range(len(p))) for j in starts):
                return False
        return True


def _within(part: tuple[bytes, ...], words: tuple[bytes, ...]) -> bool:
    return any(words[j : j + len(part)] == part for j in range(len(words) - len(part) + 1))


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
        before.append(piles[k - 1] if k else -1)
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def common(a, b, i0: int, i1: int, j0: int, j1: int) -> list[tuple[int, int]]:
    """A longest common subsequence of two short ranges."""
    n, m = i1 - i0, j1 - j0
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i0 + i] == b[j0 + j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[i0 + i] == b[j0 + j]:
            out.append((i0 + i, j0 + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a, b) -> list[tuple[int, int]]:
    """Pairs (i, j) of equal words, increasing in both, by patience: unique common words anchor, gaps are aligned alike."""
    out: list[tuple[int, int]] = []
    ranges = [(0, len(a), 0, len(b))]
    while ranges:
        i0, i1, j0, j1 = ranges.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        in_a, in_b = Counter(a[i0:i1]), Counter(b[j0:j1])
        at_b = {w: j for j, w in enumerate(b[j0:j1], j0) if in_b[w] == 1}
        anchors = [(i, at_b[w]) for i, w in enumerate(a[i0:i1], i0) if in_a[w] == 1 and w in at_b]
        if not anchors:
            if any(w in in_b for w in in_a):
                out += common(a, b, i0, i1, j0, j1)
            continue
        chosen = [anchors[k] for k in increasing([j for _, j in anchors])]
        out += chosen
        for (i, j), (k, l) in zip([(i0 - 1, j0 - 1), *chosen], [*chosen, (i1, j1)]):
            if i + 1 < k and j + 1 < l:
                ranges.append((i + 1, k, j + 1, l))
    return sorted(out)


def notices(words: list[bytes], templates: list[Template]) -> list[tuple[str, int, int, int, float]]:
    """(license, start, end, aligned words, coverage) of all places, in order, without overlaps."""
    every = frozenset().union(*(t.telling for t in templates))
    hits = [i for i, w in enumerate(words) if w in every]
    if not hits:
        return []
    found: list[tuple[str, int, int, int, float]] = []
    present = Counter(words)
    for t in templates:
        need, span = math.ceil(MIN_COVERAGE * len(t.words)), math.ceil(SLACK * len(t.words)) + 2
        bag = Counter(t.words)
        if any(w not in present for p in t.phrases for w in p) or sum(min(n, present.get(w, 0)) for w, n in bag.items()) < need:
            continue
        before = math.ceil(SLACK * t.lead) + 2
        after = start = end = shared = 0
        seen: Counter = Counter()

        def put(w: bytes, by: int) -> int:
            """Change the window by one word; by how much the words it shares with the template change."""
            if w not in bag:
                return 0
            seen[w] += by
            return by if seen[w] <= bag[w] - (by < 0) else 0

        for h in hits:
            if h < after or words[h] not in t.telling:
                continue
            first, last = max(after, h - before), min(len(words), h + span)
            if first >= end:  # nothing in common with the window before
                seen.clear()
                start = end = first
                shared = 0
            while end < last:
                shared += put(words[end], 1)
                end += 1
            while start < first:
                shared += put(words[start], -1)
                start += 1
            if shared < need:
                continue
            window = words[start:end]
            # words far before the rest belong to the text around
            pairs = _dense(align(window, t.words), span)
            if len(pairs) >= need and t.told(pairs):
                a, b = start + pairs[0][0], start + pairs[-1][0] + 1
                found.append((t.name, a, b, len(pairs), len(pairs) / len(t.words)))
                after = b
    found.sort(key=lambda f: (-f[3], -f[4], f[1], f[0]))
    kept: list[tuple[str, int, int, int, float]] = []
    for f in found:
        if all(f[2] <= k[1] or f[1] >= k[2] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[1])


def _dense(pairs: list[tuple[int, int]], span: int) -> list[tuple[int, int]]:
    """The most pairs within span words of text."""
    best, a = (0, 0), 0
    for b in range(len(pairs)):
        while pairs[b][0] - pairs[a][0] >= span:
            a += 1
        if b + 1 - a > best[1] - best[0]:
            best = (a, b + 1)
    return pairs[best[0] : best[1]]


#: An SPDX expression: identifiers joined by AND, OR and WITH.
SPDX = re.compile(rb"\(*[A-Za-z0-9][\w.+:-]*\)*(?:\s+(?:AND|OR|WITH|and|or|with)\s+\(*[A-Za-z0-9][\w.+:-]*\)*)*")
SPDX_WORDS = 24  # of text that an expression may take


def identifier(raw: list[bytes], end: int) -> str | None:
    """The SPDX expression in the words from end on; none where no identifier stands there."""
    m = SPDX.match(b" ".join(raw[end : end + SPDX_WORDS]))
    return m.group().rstrip(b".:").decode("utf-8", "replace") if m else None


def _rows_of(doc: int | None, text: bytes, templates: list[Template]) -> Iterator[tuple]:
    found = notices(words_of(text), templates)
    raw = text.split() if any(f[0] == "spdx" for f in found) else []
    for f in found:
        yield doc, *f, identifier(raw, f[2]) if f[0] == "spdx" else None


def _scanned(templates: list[Template]):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()) if text for r in _rows_of(doc, text, templates)]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "license_id", "start", "end", "n_aligned", "coverage", "identifier"])

    return per_partition


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license_id, start, end (words, end exclusive), n_aligned, coverage, identifier (SPDX): one row for each notice found."""
    small_batches(docs.sparkSession)
    own = [Template.of(k, v) for k, v in (TEMPLATES | SIBLINGS if templates is None else templates).items()]
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    return rows.mapInArrow(_scanned(own), SCHEMA)
