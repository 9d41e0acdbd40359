"""Every registered query against its SQL, over the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from pointgate.plans import queries as registered

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registered.QUERIES, registered.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    return repr(value) if isinstance(value, float) else str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, DATA)
    got = sorted_rows(df.columns, df.collect())
    result = tables.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == sorted_rows(columns, result.fetchall())
    assert got


def test_entry(spark):
    assert driver.entry(spark).count() > 0
