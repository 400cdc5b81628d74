from collections import Counter

import corpus_pipeline as P
from dwell.llm.mixing import TARGETS, drawn, mixing
from tests.conftest import SF
from tests.llm import test_exact_dedup, test_ngram_join, test_packing
from tests.llm.common_cases import awkward_rows, docs


def rows_of(df):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())


def test_stages_against_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    from dwell.llm.queries import op9_quality_rules, tokenizer_path

    df = spark.read.parquet(f"{SF}/documents.parquet")
    everything = {r.doc_id: r for r in df.collect()}
    now = {}
    for name, stage in P.STAGES:
        out = stage(spark, df, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        last, df = df, spark.read.parquet(f"{tmp_path}/{name}")
        now[name] = df
        if name != "packing":
            assert df.columns == P.COLUMNS
            assert all(everything[r.doc_id] == r for r in df.collect())
    ids = {k: Counter(r.doc_id for r in v.select("doc_id").collect()) for k, v in now.items()}
    assert set(ids["quality rules"]) == {r.doc_id for r in op9_quality_rules(spark, SF).where("kept").collect()}
    kept = [(i, everything[i].text) for i in ids["quality rules"]]
    kept = [(x[0], everything[x[0]].text) for x in test_exact_dedup.brute(kept) if x[3]]
    assert ids["exact dedup"] == Counter(i for i, _ in kept)
    near = {i for i, _, c in test_ngram_join.brute(kept) if i == c}
    assert ids["n-gram join"] == Counter(near)
    # the copies are what the rates say, and the domains' tokens are at their targets
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    mixed, _ = mixing(now["n-gram join"], labels, columns=P.COLUMNS)
    assert rows_of(drawn(mixed, P.COLUMNS)) == rows_of(now["mixing"])
    mixed = mixed.collect()
    assert {r.doc_id for r in mixed} == near
    assert all(ids["mixing"][r.doc_id] in (int(r.rate), int(r.rate) + 1) for r in mixed)
    tokens = Counter()
    for r in mixed:
        for d, x in r.posteriors.items():
            tokens[d] += r.rate * r.n_tokens * x
    shares = {d: n / sum(tokens.values()) for d, n in tokens.items()}
    total = sum(TARGETS.get(d, 0) for d in shares)
    assert all(abs(x - TARGETS[d] / total) < 0.01 for d, x in shares.items()), shares
    # packing holds each copy's tokens once
    tokenizer = Tokenizer.from_file(tokenizer_path())
    n_tokens = {i: len(tokenizer.encode(everything[i].text, add_special_tokens=False).ids) + 1 for i in near}
    pieces = now["packing"].collect()
    total = Counter()
    for p in pieces:
        total[p.doc_id] += p.length
    assert total == Counter({i: n_tokens[i] * k for i, k in ids["mixing"].items()})
    sizes = Counter()
    for p in pieces:
        sizes[p.sequence_id] += p.length
    assert all(test_packing.padded(n) == n for n in sizes.values())
    assert last.columns == P.COLUMNS


def test_awkward_rows_go_through_every_stage(spark):
    rows = awkward_rows()
    for name, stage in P.STAGES:
        out = stage(spark, docs(spark, rows), SF)
        n = out.count()
        assert n > 0 or name == "quality rules", name
        assert stage(spark, docs(spark, []), SF).count() == 0


def test_run_and_the_entry(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is P.run
    out = P.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns)


def test_texts_are_measured_and_scored_once(spark, tmp_path):
    """Of a stage that needs its rows twice, the second reading is of a table that holds what the first worked out."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    for name, work in (("quality rules", "ArrowEvalPython"), ("mixing", "regexp_count")):
        plan = dict(P.STAGES)[name](spark, df, SF)._jdf.queryExecution().toString()
        assert work not in plan and "FileScan" in plan, name


def test_run_leaves_one_table(spark):
    from pathlib import Path

    from dwell.llm.common import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    out = P.run(spark, SF)
    left = set(folder.iterdir()) - before
    assert [x.name.rsplit("-", 1)[0] for x in left] == ["dwell-mixing"]
    assert out.count() > 0
