"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from plumefeed.plans.catalog import QUERIES
from plumefeed.plans.oracle import ORACLE as SQL

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


@pytest.fixture(scope="module")
def db():
    found = duckdb.connect()
    for name in os.listdir(SF):
        found.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return found


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(spark_entry.queries())
    assert SQL.items() <= spark_entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = db.execute(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()
    assert got == sorted(expected, key=repr)
    assert got


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[:4] == ["requestId", "userId", "rank", "tweetId"]
    assert df.count() > 0
