from collections import Counter

from dwell.llm import quality_rules as Q
from dwell.llm.queries import op9_quality_rules
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs

WS = " \t\n\x0b\x0c\r"


def words(text):
    for c in WS:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in Q.SYMBOLS for c in text), dup, len(covered)


def test_measures(spark):
    rows = awkward_rows() + [(20, "a b c a b c\nx\nx\n y\n y\nz #*$%&|<>"), (21, "a a a a"), (22, "a b a b a"), (23, "a b c")]
    out = Q.quality_rules(docs(spark, rows))
    got = Counter((r.doc_id, *[r[m] for m in Q.MEASURES[:5]], r.base_failed) for r in out.collect())
    want = Counter()
    for i, t in rows:
        m = brute(t)
        want[(i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert got == want
    assert out.where("base_failed and kept").count() == 0


def test_many_distinct_words_take_the_other_way(monkeypatch):
    monkeypatch.setattr(Q, "SMALL_VOCABULARY", 3)
    w = [b"%d" % (i % 40) for i in range(300)] + [b"x%d" % i for i in range(50)]
    assert Q.repeat_words(w) == 300 == brute(" ".join(x.decode() for x in w))[4]


def test_em_finds_accurate_rules():
    rng = Q.np.random.default_rng(3)
    truth = rng.random(20_000) < 0.9
    right = [0.95, 0.9, 0.9, 0.85, 0.6, 0.55, 0.8, 0.7]
    votes = Q.np.stack([Q.np.where(rng.random(len(truth)) < 0.2, 0, Q.np.where((rng.random(len(truth)) < p) == truth, 1, -1)) for p in right], axis=1)
    model = Q.fit(Counter(map(tuple, votes.tolist())))
    score = model.prior + sum(Q.np.array(w)[votes[:, i] + 1] for i, w in enumerate(model.weights))
    assert ((score > 0) == truth).mean() > 0.97
    assert model.weights[0][2] > model.weights[4][2] >= 0


def test_empty_and_clashing_names(spark):
    assert Q.quality_rules(docs(spark, [])).count() == 0
    df = spark.createDataFrame([(1, "a b", 5.0, "m", True)], "doc_id long, text string, n_words double, m string, kept boolean")
    out = Q.quality_rules(df)
    assert out.collect()[0].n_words == 2 and out.columns.count("kept") == 1 and "m" in out.columns


def test_query_over_the_whole_table_and_labels(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = {r.doc_id: r for r in op9_quality_rules(spark, SF).collect()}
    assert out.keys() == rows.keys()
    for i, t in rows.items():
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    left = [x for x in labels if not out[x.doc_id].base_failed]
    good = [out[x.doc_id].kept for x in left if x.quality == 1]
    bad = [out[x.doc_id].kept for x in left if x.quality == 0]
    assert sum(good) / len(good) > 0.995 and sum(bad) / len(bad) < 0.25, (sum(good), len(good), sum(bad), len(bad))
