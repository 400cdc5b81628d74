import math
from collections import Counter

import numpy as np
import pytest

from dwell.llm import mixing as M
from dwell.llm.queries import op1_mixing
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs


def brute(p, t, goal, least, rounds=20_000):
    """The same least squares by many plain steps."""
    base = (t[:, None] * p).sum(axis=0)
    rate = np.maximum(1.0, least) * np.ones(len(t))
    for _ in range(rounds):
        s = (rate * t) @ p
        rate = np.maximum(least, rate - p @ np.where(base > 0, (s - goal) / np.where(base > 0, base, 1), 0))
    return rate


def cost(rate, p, t, goal):
    base = (t[:, None] * p).sum(axis=0)
    return float(((((rate * t) @ p - goal) ** 2) / base).sum() / t.sum())


@pytest.mark.parametrize("least, growth", [(0.0, 1.0), (1.0, 1.2), (0.5, 0.9)])
def test_rates_against_brute_force(spark, least, growth):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.2, 0.4], 300)
    t = rng.integers(1, 900, 300).astype(float)
    names, weights = ["a", "b", "c"], {"a": 0.5, "b": 0.1, "c": 0.4}
    slim = spark.createDataFrame([(int(n), [float(x) for x in row]) for n, row in zip(t, p)], "n_tokens long, p array<double>")
    steps = M.solve(slim, names, weights, least, growth, rounds=30, tolerance=1e-6)
    got = {(r.n_tokens, tuple(r.p)): r.rate for r in slim.withColumn("rate", M.folded(steps, least)).collect()}
    rate = np.array([got[int(n), tuple(float(x) for x in row)] for n, row in zip(t, p)])
    goal = growth * t.sum() * np.array([weights[n] for n in names])
    want = brute(p, t, goal, least)
    assert rate.min() >= least and cost(rate, p, t, goal) <= 1.1 * cost(want, p, t, goal) + 1e-5
    # the steps stop by their own proof
    assert cost(rate, p, t, goal) <= cost(want, p, t, goal) + 1.01 * M.GAP * cost(np.ones(len(t)), p, t, goal)
    if least == 0:
        assert np.abs((rate * t) @ p / t.sum() - [0.5, 0.1, 0.4]).max() < 0.01


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{SF}/../sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    model = M.train(documents, seen)
    got = M.with_posteriors(documents.join(held, "doc_id"), model, columns=["quality", "toxic"]).collect()
    right = [f"q{r.row.quality}t{r.row.toxic}" == model.domains[int(np.argmax(r.p))] for r in got]
    common = Counter(f"q{r.row.quality}t{r.row.toxic}" for r in got).most_common(1)[0][1] / len(got)
    assert sum(right) / len(right) > common + 0.1 and sum(right) / len(right) > 0.88


def test_awkward_rows(spark):
    rows = awkward_rows()
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (7, 1, 0), (7, 1, 0), (999, 0, 1), (None, 1, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    out, model = M.mixing(docs(spark, rows).withColumnRenamed("n_chars", "rate"), labels)
    got = out.collect()
    assert len(got) == len(rows) and model.domains == ["q0t0", "q1t0"] and out.columns.count("rate") == 1
    for r in got:
        assert abs(sum(r.posteriors.values()) - 1) < 1e-9 and r.rate >= 0 and math.isfinite(r.rate)
    by_id = {r.doc_id: r for r in got if r.doc_id in (1, 2, 3, 5)}
    assert [by_id[i].n_tokens for i in (1, 2, 3, 5)] == [0, 0, 0, 1]
    out, model = M.mixing(docs(spark, rows), labels.limit(0))
    assert model.domains == ["all"] and {round(r.rate, 6) for r in out.collect()} == {1.0}
    assert M.mixing(docs(spark, []), labels)[0].count() == 0
    assert M.mixing(docs(spark, rows), labels, targets={"unknown": 1.0})[0].count() == len(rows)


def test_labels_of_missing_documents_take_no_place_in_the_sample(spark):
    assert M.MAX_LABELLED == 10_000
    rows = [(i, "good words here" if i % 2 else "bad words there") for i in range(200)]
    labels = spark.range(20_000).selectExpr("id AS doc_id", "int(id % 2) AS quality", "0 AS toxic")
    model = M.train(docs(spark, rows), labels, max_labelled=200)
    assert model.domains == ["q0t0", "q1t0"] and {"good", "bad"} <= set(model.weights)


def test_drawn_copies(spark):
    df = spark.createDataFrame([(i, 2.5) for i in range(4000)] + [(9001, 0.0), (9002, 1.0), (9003, 3.0)], "doc_id long, rate double")
    n = Counter(r.doc_id for r in M.drawn(df, ["doc_id"]).collect())
    assert set(n[i] for i in range(4000)) == {2, 3} and abs(sum(n[i] for i in range(4000)) / 4000 - 2.5) < 0.05
    assert (n[9001], n[9002], n[9003]) == (0, 1, 3)


def test_no_python_runs_on_the_main_path(spark):
    docs_, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out, _ = M.mixing(docs_, labels, columns=["doc_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_meets_targets_or_the_best_that_posteriors_allow(spark):
    rows = op1_mixing(spark, SF).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    names = sorted(M.TARGETS)
    p = np.array([[r[f"p_{d}"] for d in names] for r in rows])
    t, rate = np.array([float(r.n_tokens) for r in rows]), np.array([r.rate for r in rows])
    goal = t.sum() * np.array([M.TARGETS[d] for d in names])
    off = np.abs((rate * t) @ p - goal).max() / t.sum()
    assert off <= M.TOLERANCE or cost(rate, p, t, goal) <= cost(brute(p, t, goal, 0.0), p, t, goal) + 1.01 * M.GAP * cost(np.ones(len(t)), p, t, goal)
    assert off <= 0.005, dict(zip(names, (rate * t) @ p / t.sum()))
    assert cost(rate, p, t, goal) < 0.3 * cost(np.ones(len(t)), p, t, goal)


def test_targets_out_of_reach(spark):
    """A domain with hardly a document takes thousands of steps: none of them is a job where posteriors are few."""
    import numpy as np
    from pyspark.sql import functions as F

    from dwell.llm import mixing as M

    own = np.random.default_rng(3)
    p = np.concatenate([own.dirichlet([0.002, 6.0, 0.8], 300), [[0.004, 0.9, 0.096]]])
    slim = spark.createDataFrame([(int(n), x.tolist()) for n, x in zip(own.integers(0, 300, len(p)), p)], "n_tokens long, p array<double>")
    domains = ["q0t0", "q1t0", "q1t1"]
    jobs = []
    few = M.collected(slim, 3)
    steps = M.solve(slim, domains, M.TARGETS, few=few, store=lambda df: jobs.append(df) or df)
    assert not jobs and len(steps) > 0 and M.collected(slim, 3, most=10) is None
    # the same steps as those of the jobs, and the fold over the rows gives the rates that are looked up
    goals = {"q0t0": 0.1, "q1t0": 0.7, "q1t1": 0.2}
    here, there = M.solve(slim, domains, goals, few=few, gap=1e-9, tolerance=0.02), M.solve(slim, domains, goals, gap=1e-9, tolerance=0.02, store=lambda df: df.localCheckpoint())
    assert len(here) == len(there) > 0
    assert all(np.allclose([a.ahead, *a.residual], [b.ahead, *b.residual], rtol=1e-6, atol=1e-9) for a, b in zip(here, there))
    rates = {tuple(x): r for x, r in zip(few.p.tolist(), few.rates(here, 0.0))}
    rows = slim.select("p", M.folded(here, 0.0).alias("rate")).collect()
    assert all(abs(rates[tuple(r.p)] - r.rate) < 1e-9 * max(1, r.rate) for r in rows)
