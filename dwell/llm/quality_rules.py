"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

An Arrow UDF measures whole texts. Rules turn the measures into votes: good, bad or none. The counts of the vote
patterns (at most 3 ** rules rows, whatever the input) go to the driver, where expectation-maximisation estimates the
share of good documents and for each rule how often it votes good, bad or abstains on good and on bad documents. A
document's posterior probability of being good is then a sum of log ratios, a plain column expression. Nothing is
shuffled but the pattern counts.

A base rule stands before the votes: a text with fewer than 50 words, or with more than half of its words in repeated
3-word windows, is rejected.

Edge cases: a null or empty text has no words, so the base rule rejects it; the measures of very long texts are exact;
equal rows get equal verdicts; a posterior of exactly the threshold is kept; input columns named like an output give way
to it; an empty table gives an empty result and the prior's weights.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwell.llm.common import give_back, quoted, small_batches

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
THRESHOLD = 0.5
#: Distinct words of a text up to which three word numbers fit into 63 bits.
SMALL_VOCABULARY = 1 << 20
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_noisy_words", "n_noisy_lines", "n_punctuation", "n_upper")
OUTPUTS = (*MEASURES[:5], "base_failed", "kept", "votes", "posterior")
_NOT_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_NOT_PUNCTUATION = bytes(set(range(256)) - set(string.punctuation.encode()))
_AS_NOISE = bytes.maketrans(SYMBOLS.encode(), b"#" * len(SYMBOLS))


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more in the text, each word once, first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    m = len(ids)
    if m < SMALL_VOCABULARY:
        keys = (w[:-2] * m + w[1:-1]) * m + w[2:]
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
    else:
        pairs = np.stack([w[:-2], w[1:-1], w[2:]], axis=1)
        _, where, count = np.unique(pairs, axis=0, return_inverse=True, return_counts=True)
        twice = count[where.ravel()] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    noisy_words = noisy_lines = 0
    if symbols or "!!" in text:  # a word or line is noisy if it holds one of SYMBOLS or two exclamation marks
        noise = data.translate(_AS_NOISE).replace(b"!!", b"#")
        noisy_words = sum(b"#" in w for w in noise.split())
        noisy_lines = sum(b"#" in x for x in noise.split(b"\n"))
    plain = (len(data.translate(None, x)) for x in (_NOT_PUNCTUATION, _NOT_UPPER))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words), len(lines), noisy_words, noisy_lines, *plain


def measures(text: Column) -> Column:
    """A struct of MEASURES, all long."""
    kind = "struct<" + ",".join(f"{m}:long" for m in MEASURES) + ">"

    @F.arrow_udf(kind)
    def of(texts: pa.Array) -> pa.Array:
        rows = np.array([measure(t or "") for t in texts.to_pylist()], np.int64).reshape(-1, len(MEASURES))
        give_back()
        return pa.StructArray.from_arrays([pa.array(rows[:, i].copy()) for i in range(len(MEASURES))], names=list(MEASURES))

    return of(text)


@dataclass(frozen=True)
class Rule:
    """Votes bad where one measure is beyond bad times another, good where it is within good times it."""

    name: str
    of: str
    per: str
    good: float
    bad: float

    def vote(self, m: Column) -> Column:
        x, y = m.getField(self.of), m.getField(self.per)
        up = self.bad > self.good
        is_bad = x > y * self.bad if up else x < y * self.bad
        is_good = x <= y * self.good if up else x >= y * self.good
        return F.when(y <= 0, 0).when(is_bad, -1).when(is_good, 1).otherwise(0)


#: Several rules look at each fault from another side: expectation-maximisation learns from rules that agree.
RULES = (
    Rule("few symbols", "n_symbols", "n_words", 0.05, 0.15),
    Rule("few noisy words", "n_noisy_words", "n_words", 0.05, 0.15),
    Rule("few noisy lines", "n_noisy_lines", "n_lines", 0.3, 0.6),
    Rule("little punctuation", "n_punctuation", "word_chars", 0.06, 0.09),
    Rule("mostly small letters", "n_upper", "word_chars", 0.15, 0.4),
    Rule("lines differ", "n_dup_lines", "n_lines", 0.1, 0.4),
    Rule("windows differ", "n_repeat_words", "n_words", 0.15, 0.35),
    Rule("words not too long", "word_chars", "n_words", 8.0, 12.0),
)


@dataclass
class Model:
    """log P(vote | good) - log P(vote | bad) for votes -1, 0, 1 of each rule, and the prior's log odds."""

    prior: float = 0.0
    weights: list[tuple[float, float, float]] = field(default_factory=list)

    def posterior(self, votes: Column) -> Column:
        score = F.lit(self.prior)
        for i, (bad, none, good) in enumerate(self.weights):
            v = votes[i]
            score = score + F.when(v < 0, F.lit(bad)).when(v > 0, F.lit(good)).otherwise(F.lit(none))
        return 1 / (1 + F.exp(-score))


def fit(patterns: dict[tuple[int, ...], int], n_rules: int = len(RULES), rounds: int = 50) -> Model:
    """Expectation-maximisation over vote patterns. It starts from the votes against, and a rule's good vote may never speak for bad."""
    keys = sorted(patterns)
    votes = np.array(keys, np.int64).reshape(-1, n_rules)
    n = np.array([patterns[k] for k in keys], float)
    against = (votes < 0).sum(axis=1)
    good = np.where(against == 0, 0.95, np.where(against == 1, 0.3, 0.05))
    prior, rates = 0.9, np.full((2, n_rules, 3), 1 / 3)
    for _ in range(rounds):
        prior = (1.0 + n @ good) / (2.0 + n.sum())
        for k, share in enumerate((1 - good, good)):
            for v in (-1, 0, 1):
                # two imagined documents on each side: a rule agrees with the truth, or abstains
                agree = 1.5 if v == (1 if k else -1) else 0.5 if v == 0 else 0.1
                rates[k, :, v + 1] = (n * share) @ (votes == v) + agree
            rates[k] /= rates[k].sum(axis=1, keepdims=True)
        ratio = np.log(rates[1]) - np.log(rates[0])
        ratio[:, 0], ratio[:, 2] = np.minimum(ratio[:, 0], 0), np.maximum(ratio[:, 2], 0)
        ratio[:, 1] = np.clip(ratio[:, 1], -1, 1)
        score = math.log(prior / (1 - prior)) + sum(ratio[i][votes[:, i] + 1] for i in range(n_rules))
        good = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
    ratio = np.log(rates[1]) - np.log(rates[0])
    ratio[:, 0], ratio[:, 2] = np.minimum(ratio[:, 0], 0), np.maximum(ratio[:, 2], 0)
    ratio[:, 1] = np.clip(ratio[:, 1], -1, 1)
    return Model(math.log(prior / (1 - prior)), [tuple(map(float, r)) for r in ratio])


def with_votes(docs: DataFrame, text_col: str, columns: list[str]) -> DataFrame:
    """m: the measures, v: the votes, row: the named columns."""
    small_batches(docs.sparkSession)
    out = docs.select(F.struct(*[F.col(quoted(c)).alias(c) for c in columns]).alias("row"), measures(F.col(quoted(text_col)).cast("string")).alias("m"))
    return out.withColumn("v", F.array(*[r.vote(F.col("m")) for r in RULES]))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def fitted(voted: DataFrame) -> Model:
    counted = voted.where(~base_failed(F.col("m"))).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return fit({tuple(r.v): r.n for r in counted.collect()})  # at most 3 ** rules rows


def judged(voted: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    m = F.col("m")
    return voted.withColumn("base_failed", base_failed(m)).withColumn("posterior", model.posterior(F.col("v"))).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def quality_rules(docs: DataFrame, text_col: str = "text", columns: list[str] | None = None, threshold: float = THRESHOLD, store=lambda df: df) -> DataFrame:
    """The input's columns (or those named) with OUTPUTS. store: a way to keep the measured rows. Without one the
    texts are measured three times: twice for the fit (Catalyst measures once for its filter and once for the votes) and
    once for the verdicts."""
    columns = docs.columns if columns is None else columns
    voted = store(with_votes(docs, text_col, columns))
    out = judged(voted, fitted(voted), threshold)
    return out.select(*[F.col("row").getField(c).alias(c) for c in columns if c not in OUTPUTS], *[F.col("m").getField(c).alias(c) for c in MEASURES[:5]], "base_failed", "kept", F.col("v").alias("votes"), "posterior")

