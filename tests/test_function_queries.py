"""Function queries against their SQL on rows the given tables lack."""

import math

import duckdb

from pointgate.plans import queries as registered

LINES = "l_orderkey long, l_linenumber int, l_extendedprice double, l_quantity double, l_discount double"


def same(left, right):
    return repr(left) == repr(right) or left is not None and right is not None and math.isnan(left) and math.isnan(right)


def test_strict_double_of_odd_rows(spark, tmp_path):
    values = [5.25, -7.5, 0.0, -0.0, 1.5e7, -1.5e7, 2.5e-5, 1.001, math.inf, -math.inf, math.nan, None]
    rows = [
        (key, line, value, value, value)
        for key in (None, *range(-14, 26))
        for line, value in enumerate(values)
    ] + [(3, None, 1.0, 1.0, 1.0)]
    path = str(tmp_path / "lineitem.parquet")
    spark.createDataFrame(rows, LINES).coalesce(1).write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"create view lineitem as select * from read_parquet('{path}/*.parquet')")

    def ordered(found):
        return sorted(map(tuple, found), key=lambda r: (str(r[0]), str(r[1]), repr(r[2])))

    got = ordered(registered.QUERIES["strict_double"](spark, str(tmp_path)).collect())
    want = ordered(connection.execute(registered.ORACLES["strict_double"]).fetchall())
    assert len(got) == len(want) == len(rows)
    assert [(g, w) for g, w in zip(got, want) if g[:2] != w[:2] or not same(g[2], w[2])] == []
