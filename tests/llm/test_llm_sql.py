"""The SQL twins against the same queries on the smallest tables."""

import duckdb
import pytest

from conftest import DATA
from pressloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_twin(spark, name):
    con = duckdb.connect()
    for one in ("documents", "benchmark", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {one} AS SELECT * FROM '{DATA}/{one}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    relation = con.sql(queries.ORACLE[name])
    assert sorted(relation.columns) == sorted(df.columns)
    order = [relation.columns.index(c) for c in df.columns]
    assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r[i] for i in order) for r in relation.fetchall())
