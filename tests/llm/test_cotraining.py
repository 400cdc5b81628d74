import numpy as np

from dwell.llm import cotraining as C
from dwell.llm.queries import op5_cotraining
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    n, pool = 200, 4000
    y = (rng.random(n + pool) < 0.6).astype(float)
    view = lambda: np.concatenate([np.ones((n + pool, 1)), y[:, None] * 2 - 1 + rng.normal(0, 0.8, (n + pool, 1)), rng.normal(0, 1, (n + pool, 12))], axis=1)
    a, b = view(), view()
    right = lambda m: ((m.scores(a[n:], b[n:])[2] >= 0.5) == y[n:]).mean()
    alone, taught = C.fit(a[:n], b[:n], y[:n], a[n:], b[n:], rounds=0), C.fit(a[:n], b[:n], y[:n], a[n:], b[n:])
    assert taught.n_pseudo > 200 and right(taught) > max(0.93, right(alone) - 0.005)


def plain_regression(x, y, weight):
    """Logistic regression with the constant spared, by gradient steps in the metric of the second derivatives."""
    w, penalty = np.zeros(x.shape[1]), np.r_[1e-3, np.ones(x.shape[1] - 1)]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        curve = sum(np.outer(a, a) * (k * max(q * (1 - q), 1e-6)) for a, k, q in zip(x, weight, p)) + np.diag(penalty)
        w = w - np.linalg.solve(curve, ((p - y) * weight) @ x + penalty * w)
    return w


def plain_cotraining(views, y, pools, rounds):
    """The loop with rows in lists and no sums: each row of the pool is kept with its teacher's label once it has one."""
    weight_of = lambda label, k: min(1.0, C.MAX_WEIGHT * sum(y == k) / sum(v == k for v in label)) if any(v == k for v in label) else 0.0
    taught = [{}, {}]

    def fitted(v, keep):
        own = [i for i in range(len(y)) if keep[i]]
        label = list(taught[v].values())
        x = np.array([views[v][i] for i in own] + [pools[v][i] for i in taught[v]])
        return plain_regression(x, np.array([y[i] for i in own] + label), np.array([1.0] * len(own) + [weight_of(label, k) for k in label]))

    def crossed(v):
        fold, out = C.folds_of(y), np.zeros(len(y))
        for f in range(C.FOLDS):
            out[fold == f] = views[v][fold == f] @ fitted(v, fold != f)
        return out

    for _ in range(rounds):
        full, odds = [fitted(v, np.ones(len(y), bool)) for v in (0, 1)], [crossed(v) for v in (0, 1)]
        for v in (0, 1):
            for value, sign in ((1.0, 1), (0.0, -1)):
                ranked = sorted(((1 / (1 + np.exp(-sign * o)), t == value) for o, t in zip(odds[v], y)), key=lambda r: -r[0])
                trust = 2.0
                for n in range(C.MIN_TRUST, len(ranked) + 1):
                    if sum(r for _, r in ranked[:n]) >= C.PRECISION * n:
                        trust = ranked[n - 1][0]
                for i in range(len(pools[0])):
                    if i not in taught[0] and i not in taught[1] and 1 / (1 + np.exp(-sign * (pools[v][i] @ full[v]))) >= trust:
                        taught[1 - v][i] = value
    return [fitted(v, np.ones(len(y), bool)) for v in (0, 1)], taught, [crossed(v) for v in (0, 1)]


def test_the_loop_against_a_plain_version():
    rng = np.random.default_rng(3)
    n, pool = 120, 300
    y = (rng.random(n + pool) < 0.6).astype(float)
    a = np.concatenate([np.ones((n + pool, 1)), y[:, None] * 2 - 1 + rng.normal(0, 0.7, (n + pool, 1)), rng.normal(0, 1, (n + pool, 3))], axis=1)
    b = np.concatenate([np.ones((n + pool, 1)), np.round(y[:, None] * 2 - 1 + rng.normal(0, 0.8, (n + pool, 1)))], axis=1)
    model = C.fit(a[:n], b[:n], y[:n], a[n:], b[n:], rounds=3)
    views = [(a - model.mean) / model.scale, b]
    weights, taught, odds = plain_cotraining([v[:n] for v in views], y[:n], [v[n:] for v in views], 3)
    assert model.n_pseudo == len(taught[0]) + len(taught[1]) > 60
    assert np.allclose(model.text, weights[0], atol=2e-3) and np.allclose(model.metadata, weights[1], atol=2e-3)
    # the pseudo-labelled rows' share of a part's fit is taken to second order: odds agree closely, not to the digit
    want = [C._rising(o, y[:n]) for o in odds]
    assert all(np.allclose(g, w, rtol=0.1, atol=0.1) for g, w in zip(model.calibration, want)), (model.calibration, want)
    # and what is scored is the combination of both views, calibrated
    p, q, both = model.scores(a[n:], b[n:])
    assert ((both >= 0.5) == y[n:]).mean() >= max(((p >= 0.5) == y[n:]).mean(), ((q >= 0.5) == y[n:]).mean()) - 0.02


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{SF}/../sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = C.quality_classifier(documents, seen, columns=["doc_id"]).join(held, "doc_id").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(good) / len(good) > 0.995 and sum(bad) / len(bad) < 0.1, (sum(good), len(good), sum(bad), len(bad))


def test_awkward_rows_and_few_labels(spark):
    rows = awkward_rows()
    df = docs(spark, rows).selectExpr("*", "n_chars AS score")
    label = lambda x: spark.createDataFrame(x, "doc_id long, quality int, toxic int")
    for labels, share in (([], 1.0), ([(1, 1, 0)], 1.0), ([(1, 0, 0), (2, None, 0), (None, 1, 0)], 0.0)):
        out = C.quality_classifier(df, label(labels)).collect()
        assert len(out) == len(rows) and {r.score for r in out} == {share}
    out = C.quality_classifier(df, label([(1, 0, 0), (2, 0, 0), (6, 1, 0), (7, 1, 0), (99, 1, 1), (7, 1, 0)]))
    assert out.columns.count("score") == 1 and out.count() == len(rows) and out.where("score between 0 and 1").count() == len(rows)
    assert C.quality_classifier(docs(spark, []), label([])).count() == 0
    assert C.quality_classifier(df.select("doc_id", "text"), label([(6, 1, 0), (3, 0, 0)])).count() == len(rows)


def test_sample_is_bounded(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen = {}
    real = C.fit
    C.fit = lambda *a, **k: seen.update(n=len(a[2]), pool=len(a[3])) or real(*a, **k)
    try:
        C.train(documents, labels, max_labelled=150, max_pool=70)
    finally:
        C.fit = real
    assert seen == {"n": 150, "pool": 70}


def test_every_unlabelled_row_can_teach(spark, monkeypatch):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen = {}
    real = C.fit_with
    monkeypatch.setattr(C, "fit_with", lambda text, metadata, y, pool, rounds=2: seen.update(args=(text, metadata, y), pool=pool) or real(text, metadata, y, pool, rounds))
    many = documents.unionByName(documents.crossJoin(spark.range(1, 12).withColumnRenamed("id", "k")).selectExpr("doc_id + k * 1000000 AS doc_id", "text", "lang", "source", "n_chars"))
    model = C.train(many, labels)
    rows = seen["pool"].rows.collect()
    assert len(rows) == many.join(labels, "doc_id", "left_anti").count() > 10_000
    text = np.frombuffer(b"".join(bytes(r.text) for r in rows), np.float32).reshape(len(rows), -1).astype(float)
    same = real(*seen["args"], C.LocalPool(text, C.metadata_of(np.array([r.key for r in rows]))), 2)
    assert model.n_pseudo == same.n_pseudo > 2_500
    assert np.allclose(model.text, same.text, atol=1e-6) and np.allclose(model.metadata, same.metadata, atol=1e-6)


def test_query_covers_the_whole_table(spark):
    out = op5_cotraining(spark, SF)
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    rows = out.collect()
    assert {r.doc_id for r in rows} == ids and len(rows) == len(ids)
