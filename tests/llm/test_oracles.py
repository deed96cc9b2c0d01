"""Operator queries with SQL against DuckDB on the smoke tables."""

import duckdb
import pytest

from threadline.llm.queries import ORACLE, QUERIES

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    df = QUERIES[name](spark, SMOKE)
    cols = sorted(df.columns)
    got = sorted(map(tuple, df.select(cols).collect()))
    want = con.sql(ORACLE[name])
    assert sorted(want.columns) == cols
    assert got == sorted(want.project(", ".join(cols)).fetchall())


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
