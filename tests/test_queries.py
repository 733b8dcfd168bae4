import re

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


# Queries of the training-data operators have their own tests, next to them.
NAMES = [n for n in queries() if not re.match(r"op\d+_|pipeline$", n)]


@pytest.mark.parametrize("name", [n for n in NAMES if n in oracle_sql()])
def test_query_against_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert check.rows_of(df.columns, df.collect()) == check.rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", [n for n in NAMES if n not in oracle_sql()])
def test_query_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0
