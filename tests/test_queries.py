"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="the test tables are not here")
SF_DIR = os.environ.get("TEST_SF_DIR", str(TESTDATA))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def normal(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if "datetime" in str(df[c].dtype):
            df[c] = df[c].dt.date
        df[c] = df[c].map(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert len(got)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    expected = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(expected.columns)
    got, expected = normal(got), normal(expected)
    assert len(got) == len(expected)
    assert got.equals(expected), got.compare(expected).head(10)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["CUST_ID", "MOVIE_ID", "score", "rank"] and df.limit(1).count() == 1
