import random

import pytest

from dwell.llm import license_scan as L
from dwell.llm.license_templates import SIBLINGS, TEMPLATES
from dwell.llm.queries import op4_license_scan
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs, prose


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_against_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        b = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(4)) for _ in range(rng.randint(0, 60))]
        a = [w for w in b if rng.random() > 0.15]
        for _ in range(rng.randint(0, 10)):
            a.insert(rng.randint(0, len(a)), rng.choice(["x9", "a1", "q2"]))
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:]))
        assert len(pairs) >= 0.9 * lcs(a, b)


def test_increasing():
    for values, n in (([], 0), ([3, 1, 2], 2), ([1, 2, 3], 3), ([5, 4, 3], 1), ([2, 9, 3, 4, 1, 5], 4)):
        got = [values[i] for i in L.increasing(values)]
        assert len(got) == n and got == sorted(set(got))


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_each_template_whole_edited_and_twice(name):
    rng = random.Random(name)
    own = [L.Template.of(k, v) for k, v in TEMPLATES.items()]
    text = " ".join(TEMPLATES[name].split())
    found = L.notices(L.words_of(f"{prose(rng, 50)}\n{text.upper()}\n{prose(rng, 30)} {text} {prose(rng, 9)}".encode()), own)
    assert [(f[0], f[4]) for f in found] == [(name, 1.0)] * 2
    w = text.split()
    if len(w) >= 20:
        for k in rng.sample(range(len(w)), len(w) // 10):
            w[k] = "changed%d" % k
        ((got, a, b, n, share),) = L.notices(L.words_of(f"{prose(rng, 40)} {' '.join(w)} {prose(rng, 40)}".encode()), own)
        assert got == name and share >= 0.85 and b - a <= len(w)


@pytest.mark.parametrize("name", sorted(SIBLINGS))
def test_each_sibling_whole_and_edited_outside_its_telling_words(name):
    rng = random.Random(name)
    own = [L.Template.of(k, v) for k, v in (TEMPLATES | SIBLINGS).items()]
    w = SIBLINGS[name].split()
    kept = set(b" ".join(b" ".join(p) for p in L.Template.of(name, SIBLINGS[name]).phrases).split())
    free = [i for i, x in enumerate(w) if L.words_of(x.encode())[0] not in kept]
    for edits in (0, len(w) // 20):
        for k in rng.sample(free, edits):
            w[k] = "changed%d" % k
        ((got, _, _, n, _),) = L.notices(L.words_of(f"{prose(rng, 40)} {' '.join(w)} {prose(rng, 40)}".encode()), own)
        assert got == name and n >= len(w) - edits - 2


@pytest.mark.parametrize("where", ["anywhere", "front"])
def test_edited_notices_against_whole_alignment(where):
    """Whatever notice the alignment of its whole surroundings covers far enough is found, wherever its words are changed."""
    rng, missed, tried = random.Random(where), [], 0
    for name, text in TEMPLATES.items():
        t = L.Template.of(name, text)
        if len(t.words) < 20:
            continue
        for _ in range(25):
            w = text.split()
            n = rng.randint(0, len(w) // 5)
            for k in sorted(rng.sample(range(len(w) if where == "anywhere" else min(len(w), 2 * n + 2)), n), reverse=True):
                kind = rng.random()
                w[k : k + 1] = ["changed%d" % k] if kind < 0.6 else [] if kind < 0.8 else [w[k], "more%d" % k]
            around = L.words_of(f"{prose(rng, 40)} {' '.join(w)} {prose(rng, 40)}".encode())
            pairs = L.align(around, t.words)
            if len(pairs) < L.MIN_COVERAGE * len(t.words) or not t.told(pairs):
                continue
            tried += 1
            if not any(f[0] == name for f in L.notices(around, [t])):
                missed.append((name, len(pairs) / len(t.words)))
    assert tried > 100 and not missed, (tried, missed)


def test_siblings_are_told_apart(spark):
    gnu = lambda name, version: f"This program is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
    cases = [
        ("Released under the BSD License.", []), ("released under the new license", []), ("Licensed under CC BY-NC-ND 4.0.", ["cc-by-nc-nd-4.0-line"]),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ["cc-by-nc-4.0"]),
        (gnu("GNU General Public License", 2), ["gpl-2.0"]), (gnu("GNU General Public License", 3), ["gpl-3.0"]), (gnu("GNU Affero General Public License", 3), ["agpl-3.0"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["gpl-2.0-line"]), ("SPDX-License-Identifier: (MIT OR Apache-2.0)", ["spdx"]),
    ]
    out = L.license_scan(docs(spark, [(i, t) for i, (t, _) in enumerate(cases)])).collect()
    assert [[r.license_id for r in out if r.doc_id == i] for i in range(len(cases))] == [names for _, names in cases]
    assert [r.identifier for r in out if r.license_id == "spdx"] == ["(MIT OR Apache-2.0)"]


def test_awkward_rows_and_clean_text(spark):
    assert L.license_scan(docs(spark, awkward_rows())).count() == 0
    assert L.license_scan(docs(spark, [])).count() == 0
    many = "Released under the MIT License. " * 2000
    df = spark.createDataFrame([(None, many, 1.0), (2, "license " * 3000, 1.0), (2, "Licensed under CC BY 4.0", 1.0)], "doc_id long, text string, coverage double")
    out = L.license_scan(df).collect()
    assert sum(r.doc_id is None for r in out) == 2000 and [(r.license_id, r.start, r.end) for r in out if r.doc_id == 2] == [("cc-by-4.0-line", 0, 5)]
    with pytest.raises(ValueError):
        L.Template.of("x", "this is not for you to use")


def test_query_against_plain_search(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {(r.doc_id, k) for r in rows for k in TEMPLATES if " ".join(TEMPLATES[k].split()) in " ".join((r.text or "").split())}
    got = {(r.doc_id, r.license_id) for r in op4_license_scan(spark, SF).collect()}
    assert want and want <= got and len(got - want) <= 0.05 * len(want), got - want
