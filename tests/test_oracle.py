"""Every registered query against its SQL on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
LIBRARY = set(entry.queries()) - set(entry.LLM_QUERIES)  # the others have tests of their own
QUERIES = {name: build for name, build in entry.queries().items() if name in LIBRARY}
SQL = {name: text for name, text in entry.oracle_sql().items() if name in LIBRARY}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in TABLES:
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    if isinstance(v, (bool, str)):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    mine = sorted(tuple(plain(v) for v in r) for r in df.select(*cols).collect())
    relation = con.sql(SQL[name])
    assert sorted(relation.columns) == cols
    at = [relation.columns.index(c) for c in cols]
    theirs = sorted(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    assert mine == theirs
