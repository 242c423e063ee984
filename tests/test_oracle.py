"""Every query of the catalog against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from procweave.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    try:
        x = float(v)
        return "nan" if math.isnan(x) else f"{x:.6g}"
    except (TypeError, ValueError):
        return str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    want = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    names = sorted(df.columns)
    place = [want.columns.index(n) for n in names]
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=str)
    assert got == sorted((tuple(plain(r[i]) for i in place) for r in want.fetchall()), key=str)
