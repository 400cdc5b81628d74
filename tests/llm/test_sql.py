"""Every query of the subpackage that has SQL, against DuckDB."""

from collections import Counter

import duckdb
import pytest

from dwell.llm.queries import oracle_sql, queries
from tests.conftest import SF


def value(x):
    return round(x, 9) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(oracle_sql()[name])
    names = [c[0] for c in cur.description]
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(map(value, r)) for r in df.select(*names).collect()) == Counter(tuple(map(value, r)) for r in cur.fetchall())


def test_lines_of_rows_with_repeated_and_missing_ids(spark, tmp_path):
    """A document is a row: op2 and its SQL count rows, whatever their ids are."""
    rows = [(i % 4 if i % 3 else None, "same line\nown %d\n Same Line " % i if i % 2 else "same line") for i in range(12)] + [(1, None), (1, "rare\nsame line")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cur = con.execute(oracle_sql()["op2_line_dedup"])
    names = [c[0] for c in cur.description]
    assert Counter(map(tuple, queries()["op2_line_dedup"](spark, str(tmp_path)).select(*names).collect())) == Counter(cur.fetchall())
