import hashlib
import re
from collections import Counter, defaultdict

from dwell.llm import exact_dedup as X
from dwell.llm.exact_dedup import exact_dedup
from dwell.llm.queries import op8_exact_dedup
from tests.conftest import SF
from tests.llm.common_cases import awkward_rows, docs


def sha(t):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[sha(t)].append(i)
    out, seen = [], set()
    for i, t in rows:
        g = groups[sha(t)]
        win = min((x for x in g if x is not None), default=None)
        stays = i == win and (sha(t), i) not in seen
        seen.add((sha(t), i))
        out.append((i, win, len(g), stays, sha(t)))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_awkward_and_a_hot_digest(spark):
    rows = awkward_rows() + [(1000 + i, "hot  text") for i in range(700)] + [(1300, "hot text")]
    assert got(exact_dedup(docs(spark, rows))) == brute(rows)
    assert got(exact_dedup(docs(spark, rows), columns=["doc_id"])) == brute(rows)


def test_history(spark):
    past = [(1, "a"), (2, "a"), (3, "b c")]
    now = [(10, "a"), (11, "b \n c"), (12, "new"), (9, "new"), (13, "only")]
    out = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs(spark, now), docs(spark, past)).collect()}
    assert out == {10: (1, 2, False), 11: (3, 1, False), 12: (9, 2, False), 9: (9, 2, True), 13: (13, 1, True)}
    assert exact_dedup(docs(spark, now), docs(spark, [])).where("kept").count() == 4


def test_a_stranger_on_a_slot_is_no_member(spark, monkeypatch):
    monkeypatch.setattr(X, "_key", lambda words: words[:, 0] * 0 + X.np.arange(len(words), dtype=X.np.uint64))
    rows = X.pa.table({"shard": [0, 0], "digest": [b"a" * 32, b"b" * 32], "winner": [1, 2], "copies": [1, 1]})
    _, arrays = X.mph.from_bytes(X._index_of(rows).column("index")[0].as_py())
    assert not (arrays["digests"] == X._words(X.pa.array([b"c" * 32]))).all(axis=1).any()


def test_empty_and_clashing_names(spark):
    assert exact_dedup(docs(spark, [])).count() == 0
    df = spark.createDataFrame([(1, "a", True, 3, "k"), (2, "a", True, 3, "k")], "doc_id long, text string, kept boolean, shard int, kind string")
    out = exact_dedup(df)
    assert out.columns == ["doc_id", "text", "shard", "kind", "keep_id", "group_size", "kept", "text_sha256"]
    assert [r.kept for r in out.orderBy("doc_id").collect()] == [True, False]


def test_query_over_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(op8_exact_dedup(spark, SF)) == brute(rows)
