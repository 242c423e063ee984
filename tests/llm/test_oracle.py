"""The queries of the training-data operators against DuckDB."""

import duckdb
import pytest

from procweave.llm import queries

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df, want = queries.QUERIES[name](spark, DATA), duck.sql(queries.ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    place = [want.columns.index(n) for n in names]
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == sorted(tuple(r[i] for i in place) for r in want.fetchall())
