import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dwell.llm.packing import Packer, WordTokens, combinations, nnls, packing
from dwell.llm.queries import op3_packing, tokenizer_path
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def padded(n):
    return n if n & (n - 1) == 0 else 2048


def check(rows, pieces, tokenizer):
    """pieces: (doc_id, start, length, crc, doc_tokens, sequence, offset); ids must be distinct and not null."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p[0]].append(p)
        by_sequence[p[5]].append(p)
    assert set(by_doc) == {i for i, _ in rows}
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for _, start, length, crc, n, _, _ in sorted(by_doc[i], key=lambda p: p[1]):
            assert start == at and length > 0 and n == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    used = space = 0
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p[6]):
            assert p[6] == at
            at += p[2]
        assert at <= 2048
        used, space = used + at, space + padded(at)
    return used / space


def test_query_over_the_whole_table(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert check(rows, [tuple(r) for r in op3_packing(spark, SF).collect()], tokenizer) == 1.0


def test_awkward(spark, tokenizer):
    rows = [(k, t) for k, (_, t) in enumerate(awkward_rows())] + [(50, "<|endoftext|> it's <|startoftext|>x 3.14 don't ΑΣ Σ. naïve é İI 東京 ½ a\x1cb \u0085 x")]
    out = packing(docs(spark, rows).repartition(3), tokenizer_path())
    check(rows, [(r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in out.collect()], tokenizer)
    assert packing(docs(spark, []), tokenizer_path()).count() == 0
    twice = packing(docs(spark, [(1, "a"), (1, "a"), (None, "b")]), tokenizer_path()).collect()
    assert sorted([r.doc_id for r in twice], key=str) == [1, 1, None]


def test_words_are_units_and_generations_do_not_matter(tokenizer):
    small = WordTokens(tokenizer_path(), cache_words=5)
    for t in ("Some words, some marks. Some!", "x'll we've IT'S a-b (c)", "ǅ ﬁ ŉ Straße ẞ", "1 22 3a b4", "The the THE the. the,", "", "  ", "a..  b,,"):
        for _ in range(2):
            assert np.frombuffer(small(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=120), st.integers(1, 60))
def test_every_token_has_one_place_and_all_but_the_last_window_is_full(lengths, chunk):
    packer, out = Packer(0), []
    for i in range(0, len(lengths), chunk):
        out += packer.pack([(i + k, 0, n) for k, n in enumerate(lengths[i : i + chunk])])
    out += packer.finish()
    size, at = defaultdict(int), defaultdict(int)
    for doc, start, n, q, offset in out:
        assert size[q] == offset
        size[q] += n
    for doc, start, n, _, _ in sorted(out):
        assert at[doc] == start
        at[doc] += n
    assert dict(at) == dict(enumerate(lengths)) and all(padded(n) == n for n in size.values())


def test_nnls_against_projected_gradient():
    a = combinations(16, 3).T
    b = np.random.default_rng(0).integers(0, 50, 16).astype(float)
    x, y = nnls(a, b), np.zeros(a.shape[1])
    step = 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(20_000):
        y = np.maximum(0, y - step * (a.T @ (a @ y - b)))
    assert (x >= 0).all() and np.linalg.norm(a @ x - b) <= np.linalg.norm(a @ y - b) + 1e-6
    assert (combinations(16, 3) @ np.arange(1, 17) == 16).all()
