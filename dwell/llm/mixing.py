"""Mixing to target weights by soft domain membership, with DataFrame operations alone.

The domains are the combinations of labels that the label table holds (quality and toxic). A multinomial logistic
regression over the words that a text has (and a few indicators of its shape) gives every document a posterior for each
domain. It is fitted on the labelled documents with the smallest hash of their id, at most MAX_LABELLED of them, of which
the driver sees the known words alone; its vocabulary are the MAX_WORDS words that tell most of the domain, by more than
chance (MIN_TOLD, MIN_LIFT). More words were measured to add nothing on held-out labels.

Each document then has a rate, the expected number of its copies in the mix. The expected tokens of domain k are
S_k = sum over documents of rate * tokens * posterior_k. Rates minimise sum_k (S_k - target_k) ** 2 / S0_k, subject to
rate >= min_rate, by projected gradient descent in the metric of the documents' tokens: all start at 1, and

    rate <- max(min_rate, ahead - sum_k posterior_k * (S_k(ahead) - target_k) / S0_k)

where ahead is the rate moved on in the direction of its last change (Nesterov's acceleration, which starts anew when
the cost rises). The matrix of that step has rows that sum to 1, so step length 1 never diverges. Documents of equal
posteriors have equal rates and are one row. A step is one aggregation of these rows (no shuffle beyond one row for each
task); a rate is the fold of the residuals since the state was last written, every FOLD steps. Where distinct posteriors are few (COLLECTED), the driver takes the same steps in memory. The steps end by proof:
residuals give a lower bound of the cost (the dual problem), and the cost must be as near to it as GAP of the cost at
the start, or every domain within tolerance of its target.

Edge cases: a null or empty text has no words and no tokens, its posterior is that of a text without words and its rate
follows; labels that are null or whose document is missing are ignored, and several for a document count each; without
any label there is one domain, named "all"; domains without a weight get none, weights of unknown domains are ignored,
and weights are scaled to sum to 1; equal rows get equal rates; ids may be null or repeat; extra columns stay, but those
named like an output give way to it; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwell.llm.common import SPACE_CLASS, packed, quoted, written

MAX_LABELLED = 10_000
#: Half the G statistic that a word must reach: what chance alone hardly gives to any of a million words.
MIN_TOLD = 16.0
#: How much more frequent a word must be in some domain's documents than in all.
MIN_LIFT = 2.0
#: Words that the classifier knows, those that tell most first: each is a literal of the plan.
MAX_WORDS = 192
#: The penalty on squared weights of the regression.
RIDGE = 0.3
MAX_DOMAINS = 32
#: Steps after which the state is written, so that no fold grows longer.
FOLD = 16
#: How near the cost must come to its lower bound, as a share of the cost at the start.
GAP = 1e-3
#: Distinct posteriors up to which the driver takes the steps: targets that no rates reach take thousands of them.
COLLECTED = 100_000
TOLERANCE = 1e-3
#: Shares of tokens by domain; q: quality, t: toxic.
TARGETS = {"q1t0": 0.90, "q1t1": 0.04, "q0t0": 0.055, "q0t1": 0.005}
OUTPUTS = ("n_tokens", "posteriors", "rate")


def _featured(docs: DataFrame, text_col: str, others: list[Column]) -> DataFrame:
    """others, w (words in lower case, perhaps an empty one at the ends), n_tokens and marks (indicators of shape, which
    contain a blank and so are no words). Step by step, so that no text is split twice."""
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    rows = docs.select(*others, F.split(F.lower(text), SPACE_CLASS + "+").alias("w"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("symbols"), F.regexp_count(text, F.lit("[A-Z]")).alias("capitals"))
    names = [c for c in rows.columns if c not in ("symbols", "capitals")]
    rows = rows.select(*names, "symbols", "capitals", F.size(F.array_remove("w", "")).cast("long").alias("n_tokens"))
    n = F.greatest(F.col("n_tokens"), F.lit(1))
    level = lambda name, cuts: F.concat(F.lit(name + " "), sum((F.when(F.col(name) > c * n, 1).otherwise(0) for c in cuts), F.lit(0)).cast("string"))
    return rows.select(*names, "n_tokens", F.array(level("symbols", (0.0, 0.05, 0.2)), level("capitals", (0.1, 0.5, 1.5))).alias("marks"))


@dataclass
class Model:
    domains: list[str]
    prior: list[float]  # log odds of a text without known words
    weights: dict[str, list[float]]  # what a word adds to them

    def posteriors(self, rows: DataFrame, others: list[str]) -> DataFrame:
        """others and p: an array in the order of domains. rows: w and marks as well."""
        if not self.weights:
            most = max(self.prior)
            e = [math.exp(x - most) for x in self.prior]
            return rows.select(*others, F.array(*[F.lit(x / sum(e)) for x in e]).alias("p"))
        words = F.array(*[F.lit(w) for w in self.weights])
        table = F.create_map(*[x for w, v in self.weights.items() for x in (F.lit(w), F.array(*[F.lit(float(y)) for y in v]))])
        known = rows.select(*others, F.concat(F.array_intersect("w", words), F.array_intersect("marks", words)).alias("known"))
        found = known.select(*others, F.transform("known", lambda w: F.element_at(table, w)).alias("found"))
        added = lambda k: lambda a, v: a + v[k]
        score = F.array(*[F.aggregate("found", F.lit(float(x)), added(k)) for k, x in enumerate(self.prior)])
        scored = found.select(*others, score.alias("score")).select(*others, "score", F.array_max("score").alias("most"))
        shown = scored.select(*others, F.transform("score", lambda v: F.exp(v - F.col("most"))).alias("e"))
        shown = shown.select(*others, "e", F.aggregate("e", F.lit(0.0), lambda a, b: a + b).alias("all"))
        return shown.select(*others, F.transform("e", lambda v: v / F.col("all")).alias("p"))


def regression(rows: list[tuple[list[int], int, int]], n_words: int, n_domains: int, ridge: float = RIDGE, rounds: int = 300, tolerance: float = 1e-3) -> np.ndarray:
    """Multinomial logistic regression by accelerated gradient steps. rows: known words, domain, number of such documents.
    The result has a row for each word and, last, the constant, which the penalty spares."""
    x, y, n = np.zeros((len(rows), n_words + 1), np.float32), np.zeros((len(rows), n_domains), np.float32), np.array([r[2] for r in rows], np.float32)[:, None]
    x[:, -1] = 1
    for i, (known, domain, _) in enumerate(rows):
        x[i, known] = 1
        y[i, domain] = 1
    penalty = np.full((n_words + 1, 1), ridge)
    penalty[-1] = 1e-3
    v = np.ones((n_words + 1, 1))
    for _ in range(30):  # the largest eigenvalue, by repeated multiplication
        v = x.T @ (n * (x @ v))
        most = float(np.linalg.norm(v))
        v /= most
    length = 0.55 * most + ridge
    w = ahead = np.zeros((n_words + 1, n_domains))
    k, last = 1.0, math.inf
    for _ in range(rounds):
        score = x @ ahead
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=1, keepdims=True)
        cost = -float((n * y * np.log(p + 1e-300)).sum()) + 0.5 * float((penalty * ahead**2).sum())
        new = ahead - (x.T @ (n * (p - y)) + penalty * ahead) / length
        move = np.abs(new - w).max()
        k, last, before = (1.0 if cost > last else 0.5 + math.sqrt(0.25 + k * k)), cost, k
        ahead = new + (0.0 if k == 1.0 else (before - 1) / k) * (new - w)
        w = new
        if move < tolerance:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_cols: tuple[str, ...] = ("quality", "toxic"), max_labelled: int = MAX_LABELLED) -> Model:
    """A regression over a bounded sample of the labelled rows."""
    domain = F.concat(*[F.concat(F.lit(c[0]), F.col(quoted(c)).cast("string")) for c in label_cols])
    own = labels.select(F.col(quoted(id_col)).cast("long").alias("id"), domain.alias("domain")).dropna()
    held = docs.select(F.col(quoted(id_col)).cast("long").alias("id"))  # labels of other documents take no place in the sample
    own = own.join(held, "id", "left_semi")
    sample = F.broadcast(own.orderBy(F.xxhash64(F.lit(7), "id"), "id", "domain").limit(max_labelled))
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).alias("text")).join(sample, "id")
    # written first: with all of this in one generated method, the loop over words would be too long for the JVM to compile
    rows = written(_featured(rows, "text", [F.col("domain")]).select("domain", F.concat(F.array_distinct("w"), "marks").alias("present")), "sample")
    names = [r.domain for r in sample.select("domain").distinct().orderBy("domain").limit(MAX_DOMAINS + 1).collect()]
    if len(names) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    if not names:
        return Model(["all"], [0.0], {})
    counted = rows.select("domain", F.explode("present").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(names)])
    counted = written(counted.where((F.col("n") > 1) | F.col("word").contains(" ")), "words")
    # each document has one mark of each kind, so those of one kind count the documents
    found = counted.where(F.col("word").startswith("symbols ")).agg(*[F.sum(f"n{i}").alias(d) for i, d in enumerate(names)]).first()
    sizes = {d: found[d] for d in names if found[d]}
    domains = list(sizes)
    if len(domains) < 2:
        return Model(domains or ["all"], [0.0], {})
    total = sum(sizes.values())
    counted = counted.select("word", "n", *[F.col(f"n{names.index(d)}").alias(f"n{i}") for i, d in enumerate(domains)])
    # how far the domains of a word's documents are from those of all, times their number
    share = {d: n / total for d, n in sizes.items()}
    told = sum((F.when(F.col(f"n{i}") > 0, F.col(f"n{i}") * F.log(F.col(f"n{i}") / F.col("n") / share[d])).otherwise(0.0) for i, d in enumerate(domains)), F.lit(0.0))
    # words of a language are common to its documents and say little of a domain: only marked differences count. Of each
    # kind of mark a document has exactly one, so all of them say something.
    lift = F.greatest(*[F.col(f"n{i}") / F.col("n") / share[d] for i, d in enumerate(domains)])
    words = [r.word for r in counted.where((F.col("word") != "") & (F.col("word").contains(" ") | (told >= MIN_TOLD) & (lift >= MIN_LIFT))).select("word", told.alias("told")).orderBy(F.desc("told"), "word").limit(MAX_WORDS).collect()]
    known = F.array_sort(F.array_intersect("present", F.array(*[F.lit(w) for w in words])))
    at = {w: i for i, w in enumerate(words)}
    seen = rows.groupBy("domain", known.alias("known")).agg(F.count(F.lit(1)).alias("n")).orderBy("domain", "known").collect()  # at most max_labelled rows
    w = regression([([at[x] for x in r.known], domains.index(r.domain), r.n) for r in seen], len(words), len(domains))
    return Model(domains, w[-1].tolist(), {x: w[i].tolist() for i, x in enumerate(words)})


def with_posteriors(docs: DataFrame, model: Model, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The named columns in row, n_tokens and p."""
    columns = docs.columns if columns is None else columns
    rows = _featured(docs, text_col, [packed(docs, columns).alias("row")])
    return model.posteriors(rows, ["row", "n_tokens"])


@dataclass
class Step:
    ahead: float  # how far the point of evaluation lay beyond the rates, in the direction of their last change
    residual: list[float]  # (S_k - target_k) / S0_k there


# Numbers that change from step to step stand in arrays: those are no part of the code that is compiled, which is then the same.
def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def _dot(p: Column, residual: Column) -> Column:
    return F.aggregate(F.zip_with(p, residual, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def _moved(state: Column, steps: list[Step], min_rate: float) -> Column:
    """The state (before, now) of a document after more steps."""
    if not steps:
        return state
    moves = F.array(*[_numbers([s.ahead, *s.residual]) for s in steps])
    rest = lambda m: F.slice(m, 2, F.size(m) - 1)
    move = lambda s, m: F.struct(s["now"].alias("before"), F.greatest(F.lit(float(min_rate)), s["now"] + m[0] * (s["now"] - s["before"]) - _dot(F.col("p"), rest(m))).alias("now"))
    return F.aggregate(moves, state, move)


def _once(value: Column) -> Column:
    """The value, worked out once for a row though many expressions use it: Catalyst copies no generator into them."""
    return F.explode(F.array(value))


def folded(steps: list[Step], min_rate: float) -> Column:
    """A document's rate after the steps, from its posteriors p."""
    first = F.greatest(F.lit(1.0), F.lit(float(min_rate)))
    return _moved(F.struct(first.alias("before"), first.alias("now")), steps, min_rate)["now"]


@dataclass
class Few:
    """Distinct posteriors, a row each, and the tokens of their documents."""

    p: np.ndarray
    n_tokens: np.ndarray

    def states(self, min_rate: float) -> list[np.ndarray]:
        """Rates before the last step and now."""
        return [np.full(len(self.p), max(1.0, float(min_rate))) for _ in range(2)]

    def move(self, states: list[np.ndarray], step: Step, min_rate: float) -> None:
        before, now = states
        states[:] = now, np.maximum(min_rate, now + step.ahead * (now - before) - self.p @ np.array(step.residual))

    def rates(self, steps: list[Step], min_rate: float) -> np.ndarray:
        states = self.states(min_rate)
        for step in steps:
            self.move(states, step, min_rate)
        return states[1]


def collected(slim: DataFrame, n_domains: int, most: int = COLLECTED) -> Few | None:
    """The distinct posteriors of slim, if they are no more than most."""
    rows = slim.groupBy("p").agg(F.sum("n_tokens").alias("n")).limit(most + 1).collect()
    if len(rows) > most:
        return None
    return Few(np.array([r.p for r in rows], float).reshape(-1, n_domains), np.array([r.n or 0 for r in rows], float))


def solve(slim: DataFrame, domains: list[str], targets: dict[str, float], min_rate: float = 0.0, growth: float = 1.0, rounds: int = FOLD, tolerance: float = TOLERANCE, gap: float = GAP, store=lambda df: written(df, "rates"), few: Few | None = None) -> list[Step]:
    """slim: n_tokens and p. growth: the mix's tokens over the input's. rounds: steps after which the state is stored.
    few: what collected() gave; then the driver takes the same steps, without a job for each."""
    n = range(len(domains))
    if few is not None:
        few = Few(few.p[few.n_tokens > 0], few.n_tokens[few.n_tokens > 0])
        states = few.states(min_rate)
        base = (few.n_tokens @ few.p).tolist() if len(few.p) else [0.0 for _ in n]
    else:
        first = F.greatest(F.lit(1.0), F.lit(float(min_rate)))
        state = slim.groupBy("p").agg(F.sum("n_tokens").alias("n_tokens")).where("n_tokens > 0")
        state = store(state.select("p", "n_tokens", F.struct(first.alias("before"), first.alias("now")).alias("state")))
        base = [float(x or 0.0) for x in state.agg(*[F.sum(F.col("n_tokens") * F.col("p")[i]).alias(f"s{i}") for i in n]).first()]
    wanted = [targets.get(d, 0.0) if domains != ["all"] else 1.0 for d in domains]
    all_tokens = sum(base)
    if not all_tokens or not sum(wanted):
        return []
    goal = [growth * all_tokens * w / sum(wanted) for w in wanted]
    cost_of = lambda sums: 0.5 * sum((s - g) ** 2 / b for s, g, b in zip(sums, goal, base) if b > 0)

    def bound(residual: list[float], least: float) -> float:
        """What no rates can fall below: residuals, raised till none of the documents' products with them is negative, are
        a point of the dual problem."""
        u = [x + max(0.0, -least) for x in residual]
        return sum(-0.5 * b * x * x - x * g + min_rate * b * x for x, b, g in zip(u, base, goal))

    steps: list[Step] = []
    new: list[Step] = []
    k, last, lower, start = 1.0, math.inf, 0.0, None
    ahead = 0.0

    def sums() -> tuple[list[float], list[float], float]:
        """The domains' tokens at the point of evaluation and at the rates, and the least product with the last residuals."""
        nonlocal state, new
        moved = state.select("p", "n_tokens", _once(_moved(F.col("state"), new, min_rate)).alias("state")) if new else state
        if len(new) >= rounds:
            state, new = store(moved), []
            moved = state
        now, before, t, p = F.col("state.now"), F.col("state.before"), F.col("n_tokens"), F.col("p")
        point = F.aggregate(_numbers([ahead]), now, lambda x, a: x + a * (now - before))
        least = F.min(_dot(p, _numbers(steps[-1].residual if steps else [0.0] * len(domains))))
        r = moved.agg(*[F.sum(point * t * p[i]).alias(f"a{i}") for i in n], *[F.sum(now * t * p[i]).alias(f"s{i}") for i in n], least.alias("least")).first()
        return [float(r[f"a{i}"]) for i in n], [float(r[f"s{i}"]) for i in n], r["least"]

    def sums_of_few() -> tuple[list[float], list[float], float]:
        if new:
            few.move(states, new.pop(), min_rate)
        before, now = states
        least = float((few.p @ np.array(steps[-1].residual)).min()) if steps else 0.0
        return (((now + ahead * (now - before)) * few.n_tokens) @ few.p).tolist(), ((now * few.n_tokens) @ few.p).tolist(), least

    while True:
        there, here, least = sums() if few is None else sums_of_few()
        cost = cost_of(here)
        start = cost if start is None else start
        if steps:
            lower = max(lower, bound(steps[-1].residual, least))
        if max(abs(s - g) for s, g, b in zip(here, goal, base) if b > 0) <= tolerance * all_tokens or cost - lower <= gap * start:
            return steps
        step = Step(ahead, [(s - g) / b if b > 0 else 0.0 for s, g, b in zip(there, goal, base)])
        steps.append(step)
        new.append(step)
        rises, last = cost_of(there) > last, cost_of(there)
        k, before_k = (1.0, 1.0) if rises else (0.5 + math.sqrt(0.25 + k * k), k)
        ahead = (before_k - 1) / k if k > 1 else 0.0


def mixing(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None, min_rate: float = 0.0, growth: float = 1.0, store=lambda df: df) -> tuple[DataFrame, Model]:
    """(the input's columns, or those named, with n_tokens, posteriors (a map by domain) and rate; the model).

    store: a way to keep the scored rows, of which the steps read n_tokens and p alone; without one they are scored anew.
    """
    targets = TARGETS if targets is None else targets
    columns = [c for c in (docs.columns if columns is None else columns) if c not in OUTPUTS]
    spark = docs.sparkSession
    model = train(docs, labels, id_col, text_col)
    rows = store(with_posteriors(docs, model, text_col, columns))
    slim = rows.select("n_tokens", "p")
    few = collected(slim, len(model.domains))
    steps = solve(slim, model.domains, targets, min_rate, growth, few=few)
    if few is None or len(steps) <= FOLD:
        rate = _once(folded(steps, min_rate))
    else:  # equal posteriors have equal rates: looked up, so that no row folds thousands of steps
        table = pa.table({"_p": pa.array(few.p.tolist(), pa.list_(pa.float64())), "_rate": few.rates(steps, min_rate)})
        found = F.broadcast(spark.createDataFrame(table))
        rows, rate = rows.join(found, F.col("p") == F.col("_p"), "left"), F.col("_rate")
    names = F.array(*[F.lit(d) for d in model.domains])
    out = rows.select(*[F.col("row").getField(c).alias(c) for c in columns], "n_tokens", F.map_from_arrays(names, "p").alias("posteriors"), rate.alias("rate"))
    return out, model


def drawn(mixed: DataFrame, columns: list[str], id_col: str = "doc_id") -> DataFrame:
    """As many copies of each row as its rate says: the whole part, and one more with the chance of the fraction, by a hash of the id."""
    chance = F.pmod(F.xxhash64(F.lit(31), F.col(quoted(id_col))), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return mixed.withColumn("_copies", F.explode(F.sequence(F.lit(0).cast("long"), copies))).where("_copies > 0").select(*[F.col(quoted(c)) for c in columns])
