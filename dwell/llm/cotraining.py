"""Quality by co-training: a text view and a metadata view teach each other, then both score all documents.

The labelled documents are sampled: those with the smallest hash of their id, at most MAX_LABELLED rows of a few dozen
numbers. The unlabelled ones all take part: their features are written once (about 360 bytes a document), and each round
both classifiers (logistic regressions with ridge penalty) label every one of them that they have not labelled yet;
what is as confident as proves right on held-out rows joins the other view's training set. Which rows have joined
follows from the rounds' weights and least confidences, so a pass over the features finds it anew and nothing is kept by row.
Newton's method takes its gradient and Hessian from such passes, a few thousand numbers from each task; the metadata view, whose
rows are few different ones, from the numbers of each. All pseudo-labels of a class together weigh at most MAX_WEIGHT
times as much as its labelled rows, whatever the table's size.

What a view says of labelled rows is cross-fitted: for each of FOLDS parts of them the weights are fitted anew without
that part (the pseudo-labelled rows enter there by their gradient and Hessian at the common weights). On these log odds
of all labelled rows rest the least confidences, the calibration of each view, and the logistic regression over the
calibrated log odds that combines the views. Scoring is one pass over the documents in an Arrow UDF with the two weight
vectors; nothing is shuffled.

The text view knows the text alone: its words, as the shares that fall into WORD_BUCKETS hash buckets, and measures
(symbols, capitals, repeated words, word lengths ...). The metadata view knows language, source and length only, by
hashed indicators.

Edge cases: null and empty texts are measured as no words; null metadata have an indicator of their own; labels that are
null are ignored, of several for a document the majority counts, and a tie counts as good; without labels of both
classes every score is the share of good labels (or 1); rows without an id are scored too, and count as unlabelled; equal
rows score equally; extra columns stay, but those named like an output give way to it; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwell.llm.common import quoted, small_batches, written
from dwell.llm.quality_rules import measure
from dwell.llm.word_hash import ngram_hashes

MAX_LABELLED = 10_000
ROUNDS = 5
MAX_WEIGHT = 4
PRECISION = 0.98
MIN_TRUST = 8
THRESHOLD = 0.5
BUCKETS = 64
WORD_BUCKETS = 64
FOLDS = 5
OUTPUTS = ("text_score", "metadata_score", "score", "kept")


def text_features(text: str) -> list[float]:
    n, chars, symbols, dup, repeat, lines, noisy, noisy_lines, marks, upper = measure(text)
    w, c, x = max(n, 1), max(chars, 1), max(lines, 1)
    digits = sum(map(text.count, "0123456789"))
    shares = [symbols / w, noisy / w, noisy_lines / x, marks / c, upper / c, repeat / w, dup / x, digits / c, text.count(".") / w, text.count("|") / w]
    return [1.0, *shares, *(np.sqrt(s) for s in shares), np.log1p(n), c / w, (c / w) ** 2 / 10, n / x / 20, float(n < 50), float(n == 0)]


def word_features(texts: list[str]) -> np.ndarray:
    """Roots of the shares of a text's words in each hash bucket."""
    out = np.zeros((len(texts), WORD_BUCKETS), np.float32)
    for row, (n, h) in zip(out, ngram_hashes([x.encode() for x in texts], 1)):
        if n:
            row[:] = np.sqrt(np.bincount((h % np.uint64(WORD_BUCKETS)).astype(np.int64), minlength=WORD_BUCKETS) / n)
    return out


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(1 + 2 * BUCKETS + 24)
    out[0] = 1.0
    for k, value in enumerate((lang, source)):
        out[1 + k * BUCKETS + (xxhash.xxh3_64_intdigest(value) % (BUCKETS - 1) if value is not None else BUCKETS - 1)] = 1.0
    size = -1 if n_chars is None else int(max(n_chars, 0))
    out[1 + 2 * BUCKETS + (23 if size < 0 else min(22, size.bit_length()))] = 1.0
    return out


def metadata_key(x: np.ndarray) -> np.ndarray:
    """Rows of metadata features as one number each."""
    a, b, c = x[:, 1 : 1 + BUCKETS].argmax(axis=1), x[:, 1 + BUCKETS : 1 + 2 * BUCKETS].argmax(axis=1), x[:, 1 + 2 * BUCKETS :].argmax(axis=1)
    return (a * BUCKETS + b) * 24 + c


def metadata_of(keys: np.ndarray) -> np.ndarray:
    out = np.zeros((len(keys), 1 + 2 * BUCKETS + 24))
    rows = np.arange(len(keys))
    out[:, 0] = out[rows, 1 + keys // 24 // BUCKETS] = out[rows, 1 + BUCKETS + keys // 24 % BUCKETS] = out[rows, 1 + 2 * BUCKETS + keys % 24] = 1.0
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, weight: np.ndarray | None = None, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method. The first column is the constant, which the penalty spares."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    weight = np.ones(len(y)) if weight is None else weight
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    text: np.ndarray
    metadata: np.ndarray
    calibration: tuple[np.ndarray, np.ndarray]
    combined: np.ndarray
    n_pseudo: int = 0

    def _odds(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = ((text - self.mean) / self.scale) @ self.text, metadata @ self.metadata
        return tuple(c[0] + c[1] * np.clip(o, -20, 20) for c, o in zip(self.calibration, own))

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self._odds(text, metadata)
        return sigmoid(a), sigmoid(b), sigmoid(self.combined[0] + self.combined[1] * a + self.combined[2] * b)


def _rising(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Platt's calibration; a view that would count against itself counts as nothing."""
    c = regression(np.stack([np.ones(len(y)), np.clip(odds, -20, 20)], axis=1), y, 0.01)
    return c if c[1] > 0 else np.array([regression(np.ones((len(y), 1)), y)[0], 0.0])


def _trusted(p: np.ndarray, right: np.ndarray) -> float:
    """The least confidence from which on PRECISION of the cross-fitted rows are right, or more than 1: a weak view teaches nothing."""
    order = np.argsort(-p, kind="stable")
    good = np.cumsum(right[order]) >= PRECISION * np.arange(1, len(p) + 1)
    good[: min(MIN_TRUST, len(p)) - 1] = False
    return float(p[order][np.flatnonzero(good)[-1]]) if good.any() else 2.0


def folds_of(y: np.ndarray) -> np.ndarray:
    """The part of each labelled row: of both classes every FOLDS-th, in the order of the rows."""
    out = np.zeros(len(y), int)
    for v in (0, 1):
        at = np.flatnonzero(y == v)
        out[at] = np.arange(len(at)) % FOLDS
    return out


@dataclass
class Taught:
    """A view after a round: its weights, and gradient and Hessian of what the pseudo-labelled rows add there."""

    weights: np.ndarray
    gradient: np.ndarray
    hessian: np.ndarray
    n: int = 0

    def odds(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 8) -> np.ndarray:
        """Cross-fitted log odds of labelled rows. A part without which a class is missing has those of the common weights."""
        penalty, fold, out = np.full(x.shape[1], ridge), folds_of(y), x @ self.weights
        penalty[0] = 1e-3
        for f in range(FOLDS):
            own, rest = fold == f, fold != f
            if not own.any() or len(set(y[rest])) < 2:
                continue
            w = self.weights
            for _ in range(steps):
                p = sigmoid(x[rest] @ w)
                gradient = x[rest].T @ (p - y[rest]) + penalty * w + self.gradient + self.hessian @ (w - self.weights)
                hessian = (x[rest] * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x[rest] + np.diag(penalty) + self.hessian
                step = np.linalg.solve(hessian, gradient)
                w = w - step
                if np.abs(step).max() < 1e-4:
                    break
            out[own] = x[own] @ w
        return out


@dataclass
class Round:
    weights: list[np.ndarray]  # of both views
    trust: list[tuple[float, float]]  # the least confidence of each view in good and in bad


def joined(text: np.ndarray, metadata: np.ndarray, rounds: list[Round]) -> tuple[np.ndarray, np.ndarray]:
    """(the view that each row was taught to, or -1; its label) after the rounds."""
    to, label = np.full(len(text), -1), np.zeros(len(text))
    for r in rounds:
        for v, x in enumerate((text, metadata)):
            p = sigmoid(x @ r.weights[v])
            for value, sure, trust in ((1.0, p, r.trust[v][0]), (0.0, 1 - p, r.trust[v][1])):
                best = (to < 0) & (sure >= trust)
                to[best], label[best] = 1 - v, value
    return to, label


def newton_sums(text: np.ndarray, metadata: np.ndarray, rounds: list[Round], w: np.ndarray) -> np.ndarray:
    """Of the rows taught to the text view, for bad and good ones: number, gradient and Hessian in one row of numbers."""
    to, label = joined(text, metadata, rounds)
    out = []
    for value in (0.0, 1.0):
        x = text[(to == 0) & (label == value)]
        p = sigmoid(x @ w)
        out.append(np.concatenate([[len(x)], x.T @ (p - value), ((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x).ravel()]))
    return np.stack(out)


def taught_rows(text: np.ndarray, metadata: np.ndarray, rounds: list[Round]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows taught to the metadata view: different rows, labels, numbers."""
    to, label = joined(text, metadata, rounds)
    both = np.concatenate([metadata, label[:, None]], axis=1)[to == 1]
    rows, n = np.unique(both, axis=0, return_counts=True)
    return rows[:, :-1], rows[:, -1], n.astype(float)


class LocalPool:
    def __init__(self, text: np.ndarray, metadata: np.ndarray):
        self.text, self.metadata = text, metadata

    def newton(self, mean, scale, rounds: list[Round], w: np.ndarray) -> np.ndarray:
        return newton_sums((self.text - mean) / scale, self.metadata, rounds, w)

    def taught(self, mean, scale, rounds: list[Round]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return taught_rows((self.text - mean) / scale, self.metadata, rounds)


class TablePool:
    """A table of text (floats as bytes) and key (of the metadata): each call is a pass, with one aggregation."""

    def __init__(self, rows: DataFrame, width: int):
        self.rows, self.width = rows, width

    def _each(self, of, schema: str) -> DataFrame:
        width = self.width

        def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    text = np.frombuffer(b"".join(batch.column("text").to_pylist()), np.float32).reshape(-1, width).astype(float)
                    yield from of(text, batch.column("key").to_numpy())

        return self.rows.mapInArrow(per_partition, schema)

    def newton(self, mean, scale, rounds: list[Round], w: np.ndarray) -> np.ndarray:
        size = 1 + self.width + self.width**2

        def of(text, key):
            sums = newton_sums((text - mean) / scale, metadata_of(key), rounds, w)
            yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([x.tobytes() for x in sums], pa.binary())], names=["label", "sums"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, size))
            for batch in batches:
                for k, x in zip(batch.column("label").to_pylist(), batch.column("sums").to_pylist()):
                    total[k] += np.frombuffer(x)
            yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([x.tobytes() for x in total], pa.binary())], names=["label", "sums"])

        schema, out = "label int, sums binary", np.zeros((2, size))
        for r in self._each(of, schema).mapInArrow(added, schema).toLocalIterator():  # two rows from each task
            out[r.label] += np.frombuffer(r.sums)
        return out

    def taught(self, mean, scale, rounds: list[Round]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def of(text, key):
            to, label = joined((text - mean) / scale, metadata_of(key), rounds)
            rows, n = np.unique((key * 2 + label.astype(np.int64))[to == 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(n, pa.int64())], names=["row", "n"])

        got = self._each(of, "row long, n long").groupBy("row").agg(F.sum("n").alias("n")).orderBy("row").collect()  # at most 2 * 24 * BUCKETS ** 2
        rows, n = np.array([r.row for r in got], np.int64), np.array([r.n for r in got], float)
        return metadata_of(rows // 2), (rows % 2).astype(float), n


def _weighed(y: np.ndarray, n: np.ndarray, k: float) -> float:
    """The weight of one pseudo-label of class k: together at most MAX_WEIGHT times what that class's labelled rows weigh."""
    return min(1.0, MAX_WEIGHT * float((y == k).sum()) / n) if n else 0.0


def _taught_regression(x: np.ndarray, y: np.ndarray, sums, w: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Taught:
    """Newton's method over labelled rows and the sums over pseudo-labelled ones, from w on."""
    d, penalty = x.shape[1], np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = sigmoid(x @ w)
        far = sums(w)
        share = [_weighed(y, far[k, 0], float(k)) for k in (0, 1)]
        more, curve = (sum(share[k] * far[k, a:b] for k in (0, 1)) for a, b in ((1, 1 + d), (1 + d, None)))
        curve = curve.reshape(d, d)
        hessian = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty) + curve
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty * w + more)
        taught = Taught(w - step, more - curve @ step, curve, int(far[:, 0].sum()))
        w = taught.weights
        if np.abs(step).max() < 1e-4:
            break
    return taught


def _taught_rows_regression(x: np.ndarray, y: np.ndarray, rows: np.ndarray, label: np.ndarray, n: np.ndarray) -> Taught:
    """The same where the pseudo-labelled rows are at hand: different rows, labels and numbers."""
    rows = rows.reshape(-1, x.shape[1])
    share = np.array([_weighed(y, n[label == k].sum(), k) for k in (0.0, 1.0)])
    weight = n * share[label.astype(int)]
    w = regression(np.concatenate([x, rows]), np.concatenate([y, label]), weight=np.concatenate([np.ones(len(y)), weight]))
    p = sigmoid(rows @ w)
    return Taught(w, rows.T @ (weight * (p - label)), (rows * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ rows, int(n.sum()))


def fit(text: np.ndarray, metadata: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_metadata: np.ndarray, rounds: int = ROUNDS) -> Model:
    return fit_with(text, metadata, y, LocalPool(pool_text, pool_metadata), rounds)


def fit_with(text: np.ndarray, metadata: np.ndarray, y: np.ndarray, pool: LocalPool | TablePool, rounds: int = ROUNDS) -> Model:
    """Rows in an order that says nothing about y."""
    mean, scale = text.mean(axis=0), text.std(axis=0)
    mean[0], scale = 0.0, np.where(scale > 1e-9, scale, 1.0)
    scale[0] = 1.0
    views = [(text - mean) / scale, metadata]
    none = lambda v: (np.zeros(v.shape[1]), np.zeros((v.shape[1],) * 2))
    taught = [Taught(regression(v, y), *none(v)) for v in views]
    odds = [t.odds(v, y) for t, v in zip(taught, views)]
    so_far: list[Round] = []
    for _ in range(rounds):
        trust = [(_trusted(sigmoid(o), y == 1), _trusted(sigmoid(-o), y == 0)) for o in odds]
        so_far = [*so_far, Round([t.weights for t in taught], trust)]
        now, before = so_far, sum(t.n for t in taught)
        taught = [_taught_regression(views[0], y, lambda w: pool.newton(mean, scale, now, w), taught[0].weights), _taught_rows_regression(views[1], y, *pool.taught(mean, scale, now))]
        odds = [t.odds(v, y) for t, v in zip(taught, views)]
        if sum(t.n for t in taught) == before:
            break
    calibration = tuple(_rising(o, y) for o in odds)
    both = [c[0] + c[1] * np.clip(o, -20, 20) for c, o in zip(calibration, odds)]
    x = np.stack([np.ones(len(y)), *both], axis=1)
    combined = regression(x, y, 0.01)
    if combined[1:].min() < 0:  # a view that would count against itself is left out, and the rest fitted anew
        x[:, 1 + int(np.argmin(combined[1:]))] = 0
        combined = np.maximum(regression(x, y, 0.01), [-np.inf, 0, 0])
    return Model(mean, scale, taught[0].weights, taught[1].weights, calibration, combined, sum(t.n for t in taught))


def _measured(text: Column, lang: Column, source: Column, n_chars: Column) -> Column:
    @F.arrow_udf("struct<text:array<double>,metadata:array<double>>")
    def of(t: pa.Array, a: pa.Array, b: pa.Array, n: pa.Array) -> pa.Array:
        x, m = _matrices(t, a, b, n)
        kind = pa.list_(pa.float64())
        return pa.StructArray.from_arrays([pa.array(list(x), kind), pa.array(list(m), kind)], names=["text", "metadata"])

    return of(text, lang, source, n_chars)


def _matrices(t: pa.Array, a: pa.Array, b: pa.Array, n: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = [x or "" for x in t.to_pylist()]
    text = np.array([text_features(x) for x in texts], np.float32).reshape(len(t), -1)
    text = np.concatenate([text, word_features(texts)], axis=1).astype(float)
    seen: dict[tuple, np.ndarray] = {}
    rows = []
    for key in zip(a.to_pylist(), b.to_pylist(), n.to_pylist()):
        if key not in seen:
            seen[key] = metadata_features(*key)
        rows.append(seen[key])
    return text, np.array(rows, float).reshape(len(t), -1)


def _inputs(docs: DataFrame, names: tuple[str, str, str, str]) -> list[Column]:
    kinds = ("string", "string", "string", "long")
    return [F.col(quoted(c)).cast(k) if c in docs.columns else F.lit(None).cast(k) for c, k in zip(names, kinds)]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", names: tuple[str, str, str, str] = ("text", "lang", "source", "n_chars"), max_labelled: int = MAX_LABELLED, max_pool: int | None = None) -> Model | float:
    """A model, or the share of good labels where they are all alike. The pool are all unlabelled rows, or max_pool of them."""
    small_batches(docs.sparkSession)
    rank = F.xxhash64(F.lit(99), "id")
    own = labels.select(F.col(quoted(id_col)).cast("long").alias("id"), (F.col(quoted(label_col)) > 0).cast("double").alias("y")).dropna()
    own = own.groupBy("id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    chosen = own.orderBy(rank, "id").limit(max_labelled)
    wide = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), *[c.alias(f"c{i}") for i, c in enumerate(_inputs(docs, names))])
    chosen = F.broadcast(chosen)  # at most max_labelled rows
    if max_pool is not None:
        pool = wide.select("id").where("id is not null").join(own.select("id"), "id", "left_anti").distinct().orderBy(rank, "id").limit(max_pool)
        chosen = F.broadcast(chosen.unionByName(pool.withColumn("y", F.lit(None).cast("double"))))
    rows = wide.join(chosen, "id").select("id", "y", _measured(*[F.col(f"c{i}") for i in range(4)]).alias("m"))
    got = rows.dropDuplicates(["id"]).orderBy(rank, "id").toPandas()
    known = got[got.y.notna()]
    if known.y.nunique() < 2:
        return float(known.y.mean()) if len(known) else 1.0
    matrix = lambda rows, k, like: np.array([m[k] for m in rows.m], float).reshape(len(rows), like)
    n_text, n_meta = len(known.m.iloc[0]["text"]), len(known.m.iloc[0]["metadata"])
    text, metadata, y = matrix(known, "text", n_text), matrix(known, "metadata", n_meta), known.y.to_numpy()
    if max_pool is not None:
        rest = got[got.y.isna()]
        return fit(text, metadata, y, matrix(rest, "text", n_text), matrix(rest, "metadata", n_meta))
    # measured before the join, so that no text is shuffled for it
    measured = wide.mapInArrow(_features, "id long, text binary, key long")
    return fit_with(text, metadata, y, TablePool(written(measured.join(own.select("id"), "id", "left_anti").select("text", "key"), "features"), n_text))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            text, metadata = _matrices(*[batch.column(f"c{i}") for i in range(4)])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x.tobytes() for x in text.astype(np.float32)], pa.binary()), pa.array(metadata_key(metadata), pa.int64())], names=["id", "text", "key"])


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", names: tuple[str, str, str, str] = ("text", "lang", "source", "n_chars"), columns: list[str] | None = None, threshold: float = THRESHOLD, model: Model | float | None = None) -> DataFrame:
    """The input's columns (or those named) with text_score, metadata_score, score (of being good) and kept."""
    model = train(docs, labels, id_col, label_col, names) if model is None else model

    @F.arrow_udf("struct<text_score:double,metadata_score:double,score:double>")
    def scored(t: pa.Array, a: pa.Array, b: pa.Array, n: pa.Array) -> pa.Array:
        out = model.scores(*_matrices(t, a, b, n)) if isinstance(model, Model) else [np.full(len(t), float(model))] * 3
        return pa.StructArray.from_arrays([pa.array(x, pa.float64()) for x in out], names=["text_score", "metadata_score", "score"])

    small_batches(docs.sparkSession)
    columns = [c for c in (docs.columns if columns is None else columns) if c not in OUTPUTS]
    out = docs.select(F.struct(*[F.col(quoted(c)).alias(c) for c in columns]).alias("row"), scored(*_inputs(docs, names)).alias("s"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in columns], "s.text_score", "s.metadata_score", "s.score", (F.col("s.score") >= threshold).alias("kept"))
