"""Small tables with the cases that every operator must bear."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.08 else "") for w in words)


def docs(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], schema)


def awkward_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty, white space, ties, equal rows, non-ASCII, odd line ends, one very long text."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "ÄÖ Éa b c"), (4, "ÄÖ Éa b c"), (5, "one"), (6, "One  two\tthree\r\nfour\n\nfour"),
        (7, long), (8, long + " end"), (8, "other text under the same id"), (None, "no id"), (None, "no id"), (9, "no id"), (10, "a b c d e"), (11, "A B\nC D E"), (12, "\n\n\n"),
    ]
