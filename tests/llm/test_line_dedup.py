import hashlib
import random
from collections import Counter

from dwell.llm import line_dedup as L
from dwell.llm.line_dedup import line_dedup
from dwell.llm.queries import op2_line_dedup
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, min_docs=10, min_chars=1):
    df = Counter()
    for _, t in rows:
        df.update({key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= min_chars and df[key(x)] >= min_docs)]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()], key=str)


def test_awkward(spark):
    rows = awkward_rows() + [(100 + i, " Shared É\t\nown %d\n\nx" % i) for i in range(12)] + [(200 + i, "é") for i in range(20)] + [(300 + i, "z") for i in range(9)]
    assert got(line_dedup(docs(spark, rows))) == brute(rows)
    assert got(line_dedup(docs(spark, rows), min_docs=3, min_chars=2)) == brute(rows, 3, 2)


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(L, "KEYS_IN_SHARD", 3)
    rng = random.Random(1)
    rows = [(i, "\n".join("line %d" % rng.randint(0, 60) for _ in range(20))) for i in range(60)]
    assert got(line_dedup(docs(spark, rows), min_docs=12)) == brute(rows, 12)


def test_empty_and_clashing_names(spark):
    assert line_dedup(docs(spark, [])).count() == 0
    df = spark.createDataFrame([(1, "a\nb", 7, "x", 5)], "doc_id long, text string, n_lines int, row string, hi long")
    out = line_dedup(df)
    assert out.columns == ["doc_id", "row", "hi", "text", "n_lines", "n_dropped"] and out.collect()[0].n_lines == 2


def test_query_over_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute(rows)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op2_line_dedup(spark, SF).collect()} == want
    assert any(d for _, d, _ in want.values())
