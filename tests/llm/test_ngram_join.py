import random
import re

import numpy as np
import pytest

from dwell.llm import ngram_join as N
from dwell.llm import word_hash
from dwell.llm.components import components
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs, prose


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, percent=80, k=5):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    common = {}
    for own in holders.values():
        for a in range(len(own)):
            for b in range(a):
                common[own[b], own[a]] = common.get((own[b], own[a]), 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=str)


def families(rng, n_families, size, n_words, edits):
    out = []
    for _ in range(n_families):
        base = prose(rng, n_words).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_families_passages_and_awkward_rows(spark, seed):
    rng = random.Random(seed)
    texts = families(rng, 12, 6, 60, 3) + families(rng, 10, 5, 9, 1) + families(rng, 8, 4, 300, 14)
    passage = prose(rng, 60)
    texts += [prose(rng, rng.randint(5, 200)) + " " + passage + " " + prose(rng, rng.randint(0, 40)) for _ in range(60)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(4, 9))) for _ in range(80)]
    rng.shuffle(texts)
    rows = awkward_rows() + [(100 + i, t) for i, t in enumerate(texts)]
    assert got(N.ngram_join(docs(spark, rows).repartition(5))) == brute(rows)


def test_one_large_family_over_many_blocks(spark):
    rng = random.Random(4)
    texts = families(rng, 1, 150, 60, 6)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    assert got(N.ngram_join(docs(spark, rows).repartition(4), block=16)) == brute(rows)


def test_the_shuffled_way_to_the_texts(spark, monkeypatch):
    monkeypatch.setattr(N, "BROADCAST_ROWS", 0)
    rows = awkward_rows() + [(50 + i, t) for i, t in enumerate(families(random.Random(3), 5, 4, 50, 2))]
    assert got(N.ngram_join(docs(spark, rows))) == brute(rows)


def test_empty_and_clashing_names(spark):
    assert N.ngram_join(docs(spark, [])).count() == 0
    assert got(N.ngram_join(docs(spark, [(3, None), (None, "")]))) == [(3, 0, 3), (None, 0, None)]
    df = spark.createDataFrame([(1, "a b c d e f", 1, 2, 3), (2, "a b c d e f", 1, 2, 3)], "doc_id long, text string, node long, cluster long, kind int")
    assert got(N.ngram_join(df)) == [(1, 2, 1), (2, 2, 1)]


def test_query_over_the_whole_table(spark):
    from dwell.llm.queries import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(queries()["op7_ngram_join"](spark, SF)) == brute(rows)


def test_hashes_do_not_depend_on_place_or_piece(monkeypatch):
    rng = random.Random(0)
    texts = [prose(rng, n).encode() for n in (0, 1, 4, 5, 6, 300, 20)]
    whole = [h.tolist() for _, h in word_hash.ngram_hashes(texts, 5)]
    assert [len(h) for h in whole] == [0, 1, 1, 1, 2, 296, 16]
    monkeypatch.setattr(word_hash, "PIECE_BYTES", 50)
    assert [h.tolist() for _, h in word_hash.ngram_hashes(texts, 5)] == whole
    assert len({tuple(h) for h in whole}) == 7


def test_overlaps_by_chunks():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(20)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert N.overlaps(sets, 7).tolist() == want == N.overlaps(sets).tolist()


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(200)] + [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(150)] + [(7, 7), (-5, 2000), (2000, -9)]
    out = {r.v: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in edges:
        if a != b:
            x, y = want.get(a, {a}), want.get(b, {b})
            x = x | y
            for v in x:
                want[v] = x
    assert out == {v: min(g) for v, g in want.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
