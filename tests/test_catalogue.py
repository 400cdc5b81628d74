"""Every query that has SQL, against DuckDB over the same tables."""

from collections import Counter

import duckdb
import pytest

from dwell.plans.catalogue import oracle_sql, queries
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    if name not in oracle_sql():
        assert df.count() > 0
        return
    cur = con.execute(oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    got, want = Counter(map(tuple, df.select(*[f"`{n}`" for n in names]).collect())), Counter(cur.fetchall())
    assert sum(got.values()) > 0
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
