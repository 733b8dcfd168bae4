"""Registered queries next to their SQL."""

import pytest

from codesift.llm.queries import QUERIES
from codesift.llm.twins import TWINS


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_against_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
    result = duck.execute(TWINS[name])
    names = [d[0] for d in result.description]
    at = [names.index(c) for c in columns]
    want = sorted(tuple(str(r[i]) for i in at) for r in result.fetchall())
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
