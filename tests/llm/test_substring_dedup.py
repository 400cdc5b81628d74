import random
import re
from collections import defaultdict

import numpy as np
import pytest

from dwell.llm import substring_dedup as S
from dwell.llm.queries import op10_substring_dedup
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs, prose


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def edited(rng, w, every):
    out = []
    for x in w:
        k = rng.random() * every
        out += [] if k < 0.3 else ["new%d" % rng.randrange(10**6)] if k < 0.7 else [x, "more%d" % rng.randrange(10**6)] if k < 1 else [x]
    return out


def planted(seed, copies, every):
    """Documents of which some hold an (edited) passage: rows and, by id, where it stands."""
    rng = random.Random(seed)
    passage, rows, places = prose(rng, 80).split(), [], {}
    for i in range(60):
        w = prose(rng, rng.randint(0, 300)).split()
        if i % 60 < copies:
            own, at = edited(rng, passage, every) if every else passage, rng.randint(0, len(w))
            w[at:at] = own
            places[i + 1] = (at, at + len(own))
        rows.append((i + 1, " ".join(w)))
    return rows, places


def test_planted_passages(spark):
    for seed, copies, every in ((1, 2, 0), (2, 40, 0), (3, 12, 25), (4, 2, 30)):
        rows, places = planted(seed, copies, every)
        out = S.substring_dedup(docs(spark, rows).repartition(4)).collect()
        seen = {r.doc_id for r in out} | {r.source_doc_id for r in out}
        assert seen == set(places), (seed, seen ^ set(places))
        for r in out:
            a, b = places[r.doc_id]
            assert min(b, r.passage_end) - max(a, r.passage_start) >= 0.85 * (b - a) and r.passage_end - r.passage_start <= b - a + 8
            assert r.n_equal >= 0.7 * (r.end - r.start) and r.source_doc_id < r.doc_id


def test_awkward_rows(spark):
    rows = awkward_rows() + [(30, "x " * 200), (31, "y " * 70)]
    out = S.substring_dedup(docs(spark, rows)).collect()
    assert {(r.doc_id, r.source_doc_id) for r in out} == {(8, 7)}
    assert max(r.end for r in out) == 30_000
    assert S.substring_dedup(docs(spark, [])).count() == 0
    same = [(5, prose(random.Random(1), 100))] * 3
    assert S.substring_dedup(docs(spark, same)).count() == 0


def test_a_passage_held_twice_whatever_the_partitions(spark):
    rng = random.Random(11)
    passage, rows, places = prose(rng, 70).split(), [], {}
    for i in range(1, 9):
        a, b, c = (prose(rng, 40).split() for _ in range(3))
        rows.append((i, " ".join(a + passage + b + passage + c)))
        places[i] = {(40, 110), (150, 220)}
    for n in (1, 8):
        out = S.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(n, "doc_id") if n == 1 else docs(spark, rows).repartitionByRange(n, "doc_id")).collect()
        for i in range(2, 9):
            got = {(r.passage_start, r.passage_end) for r in out if r.doc_id == i}
            assert got == places[i], (n, i, got)


def replaced(rng, w, rate):
    """Words changed, dropped or added, each with a share of the rate."""
    out = []
    for x in w:
        k = rng.random()
        out += [x] if k >= rate else ["new%d" % rng.randrange(10**9)] if k < 0.6 * rate else [] if k < 0.8 * rate else [x, "new%d" % rng.randrange(10**9)]
    return out


@pytest.mark.parametrize("rate, least", [(0.0, 1.0), (0.04, 0.99), (0.08, 0.95), (0.12, 0.9)])
def test_recall_of_edited_passages(spark, rate, least):
    rng, rows = random.Random(int(100 * rate)), []
    for i in range(120):
        passage = prose(rng, rng.randint(60, 120)).split()
        rows += [(2 * i + k, " ".join(prose(rng, 30).split() + (replaced(rng, passage, rate) if k else passage) + prose(rng, 30).split())) for k in (0, 1)]
    out = S.substring_dedup(docs(spark, rows)).collect()
    assert all(r.source_doc_id == r.doc_id - 1 for r in out)
    recall = len({r.doc_id for r in out}) / 120
    print(f"recall at {rate}: {recall:.3f}")
    assert recall >= least


def test_short_parts_of_several_sources_are_no_passage(spark):
    rng = random.Random(21)
    a, b, c = (prose(rng, 30).split() for _ in range(3))
    around = lambda w: " ".join(prose(rng, 40).split() + w + prose(rng, 40).split())
    assert S.substring_dedup(docs(spark, [(1, around(a)), (2, around(b)), (3, around(a + b))])).count() == 0
    # two runs of 30 words and 40 other words between them are none either
    assert S.substring_dedup(docs(spark, [(1, around(a + prose(rng, 40).split() + b)), (2, around(a + prose(rng, 40).split() + b))])).count() == 0
    # but where another document holds the whole, it is found, though smaller ones hold all its parts
    rows = [(1, around(a)), (2, around(b)), (3, around(c)), (4, around(a + b + c)), (5, around(a + b + c)), (6, around(b + c)), (7, around(b + c))]
    out = S.substring_dedup(docs(spark, rows)).collect()
    assert {(r.doc_id, r.source_doc_id) for r in out} >= {(5, 4)} and {r.doc_id for r in out} == {5, 6, 7}


def test_rows_do_not_depend_on_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(S, "FLUSH", 600)  # several bundles in a task
    rows, _ = planted(31, 20, 0)
    more, _ = planted(32, 12, 20)
    rows += [(i + 100, t) for i, t in more]
    got = [sorted(tuple(r) for r in S.substring_dedup(docs(spark, rows).repartition(n, "doc_id")).collect()) for n in (1, 2, 6)]
    assert got[0] and got[0] == got[1] == got[2]


def test_rows_without_an_id_take_part(spark):
    rng = random.Random(41)
    p, q = prose(rng, 70).split(), prose(rng, 70).split()
    around = lambda w: " ".join(prose(rng, 20).split() + w + prose(rng, 20).split())
    out = S.substring_dedup(docs(spark, [(5, around(p)), (None, around(p)), (None, around(q)), (None, around(q))])).collect()
    assert sorted(((r.doc_id, r.source_doc_id) for r in out), key=str) == [(None, 5), (None, None)]


def plain_windows(rows, min_words=S.MIN_WORDS):
    """Every pair of documents: (document, place) of each window of min_words words that a smaller document holds too."""
    grams = defaultdict(list)
    for i, w in rows:
        for k in range(len(w) - min_words + 1):
            grams[tuple(w[k : k + min_words])].append((i, k))
    return [(i, k) for places in grams.values() for i, k in places if any(j < i for j, _ in places)]


def test_exact_passages_against_all_pairs(spark):
    rng = random.Random(51)
    stock = [prose(rng, rng.randint(20, 90)).split() for _ in range(12)]
    rows = [(i, sum((rng.choice(stock) if rng.random() < 0.5 else prose(rng, rng.randint(1, 60)).split() for _ in range(rng.randint(1, 8))), [])) for i in range(150)]
    want = plain_windows(rows)
    out = S.substring_dedup(docs(spark, [(i, " ".join(w)) for i, w in rows]).repartition(5)).collect()
    got = defaultdict(set)
    for r in out:
        got[r.doc_id].update(range(r.start, r.end))
    # each is in pieces but for REACH words at either end; fuzzy pieces may say more, but none says much that is not equal
    assert len(want) > 100 and all(len(got[i] & set(range(k, k + 50))) >= 50 - 2 * S.REACH for i, k in want)
    assert sum(len(set(range(k, k + 50)) - got[i]) for i, k in want) <= 0.02 * 50 * len(want)
    words_ = dict(rows)
    for r in out:
        assert S.equal_in_gap(words_[r.doc_id][r.start : r.end], words_[r.source_doc_id][r.source_start : r.source_end]) >= r.n_equal > 0.6 * max(r.end - r.start, r.source_end - r.source_start) - 1


def test_the_shuffled_way_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    rows, places = planted(7, 5, 0)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, doc int, source int")
    out = S.substring_dedup(df).collect()
    assert {r.doc_id for r in out} | {r.source_doc_id for r in out} == set(places)


def test_query_finds_every_long_exact_run(spark):
    rows = [(r.doc_id, words(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    holders = defaultdict(set)
    for i, w in rows:
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    shared = set().union(*(v for v in holders.values() if len(v) > 1))
    out = op10_substring_dedup(spark, SF).collect()
    found = {r.doc_id for r in out} | {r.source_doc_id for r in out}
    assert shared and shared <= found
    by_id = dict(rows)
    for r in out:
        assert r.passage_end - r.passage_start >= 50 and r.passage_start <= r.start < r.end <= r.passage_end <= len(by_id[r.doc_id])
        assert r.n_equal >= 0.6 * (r.end - r.start) - 1


def test_chains_against_all_predecessors():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 25))
        p, q = rng.integers(0, 150, n), rng.integers(0, 150, n)
        size, seeds = rng.integers(6, 15, n), rng.integers(1, 3, n)
        got = S.chains(p, q, size, seeds)
        weight = np.minimum(size, seeds * S.K)
        order, score = np.argsort(p, kind="stable"), {}
        for i in order:
            best = [score[j] - S.GAP_COST * (p[i] + q[i] - p[j] - size[j] - q[j] - size[j]) for j in score if p[j] + size[j] <= p[i] and q[j] + size[j] <= q[i]]
            score[i] = weight[i] + max([0, *best])
        best = got[0]
        total = sum(weight[i] for i in best) - S.GAP_COST * sum(p[b] + q[b] - p[a] - size[a] - q[a] - size[a] for a, b in zip(best, best[1:]))
        assert abs(total - max(score.values())) < 1e-9 and sorted(i for c in got for i in c) == list(range(n))


def test_minimizers_cover_every_window():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 10, 11, 64, 300):
        h = rng.integers(0, 50 if n == 64 else 2**63, n).astype(np.uint64)
        got = set(S.minimizers(h).tolist())
        want = {i + int(k) for i in range(max(1, n - S.WINDOW + 1)) for k in np.flatnonzero(h[i : i + S.WINDOW] == h[i : i + S.WINDOW].min())} if n else set()
        assert got == want
