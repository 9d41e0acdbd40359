import math
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pointgate.functions import numbers as N

GOOD = {
    "1": 1.0, "-1.5": -1.5, "+2": 2.0, "5.": 5.0, ".5": 0.5, "1e3": 1000.0, "1E-3": 0.001, "-.5e+1": -5.0,
    "inf": math.inf, "-INF": -math.inf, "+Infinity": math.inf, "infinity": math.inf, "1e400": math.inf, "0": 0.0,
    "9007199254740993": 9007199254740992.0,
}
BAD = ["", " 1", "1 ", "1d", "1f", "0x1p3", "0x10", "1_000", "1,5", ".", "+", "e5", "1e", "--1", "1\n", "true", "in", "nanx"]


def test_strict_double_values(spark):
    df = spark.createDataFrame(list(GOOD.items()), "text string, want double")
    wrong = df.withColumn("got", N.strict_double(F.col("text"))).filter("got is null or got <> want")
    assert wrong.collect() == []


@pytest.mark.parametrize("text", ["nan", "NaN", "+nan", "-NAN"])
def test_strict_double_nan(spark, text):
    row = spark.range(1).select(N.strict_double(F.lit(text)).alias("v")).first()
    assert math.isnan(row.v)


def test_strict_double_rejects(spark):
    df = spark.createDataFrame([(t,) for t in BAD], "text string")
    assert df.filter(N.strict_double(F.col("text")).isNotNull()).collect() == []


def test_hex(spark):
    cases = {
        "0x10": 16, "10": 16, "0x0x1f": 31, "FF": 255, "0xffffffffffffffff": 2**64 - 1, "+a": 10, "0x0": 0, "0000": 0,
        "0x00000000000000000001": 1, "": None, "0x": None, "xyz": None, "-1": None, "0x1ffffffffffffffff": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "text string")
    rows = df.select("text", N.hex_to_decimal_text(F.col("text")).alias("v")).collect()
    assert {r.text: None if r.v is None else int(r.v) for r in rows} == cases


def test_saturating(spark):
    df = spark.createDataFrame([(1.9,), (-5.0,), (1e30,), (0.0,), (9.3e18,)], "v double")
    assert [r[0] for r in df.select(N.saturating_bigint(F.col("v"))).collect()] == [1, 0, N.BIGINT_MAX, 0, N.BIGINT_MAX]


TEXTS = [
    # value, CSV text, JSON text
    (1.0, "1", "1.0"),
    (-0.0, "-0", "-0.0"),
    (0.1, "0.1", "0.1"),
    (1e7, "10000000", "10000000.0"),
    (1e15, "1000000000000000", "1000000000000000.0"),
    (1e16, "10000000000000000", "1e16"),
    (1.5e300, "15" + "0" * 299, "1.5e300"),
    (1e-5, "0.00001", "0.00001"),
    (9.9e-6, "0.0000099", "9.9e-6"),
    (1e-7, "0.0000001", "1e-7"),
    (-1.25e-7, "-0.000000125", "-1.25e-7"),
    (2e23, "2" + "0" * 23, "2e23"),
    (123456.789, "123456.789", "123456.789"),
    (5e-324, "0." + "0" * 323 + "5", "5e-324"),
]


def test_number_text(spark):
    df = spark.createDataFrame([(v,) for v, _, _ in TEXTS], "v double").coalesce(1)
    rows = df.select(N.csv_number("v").alias("c"), N.json_number("v").alias("j")).collect()
    assert [(r.c, r.j) for r in rows] == [(c, j) for _, c, j in TEXTS]


def test_number_text_special(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (None,)], "v double").coalesce(1)
    rows = df.select(N.csv_number("v").alias("c"), N.json_number("v").alias("j")).collect()
    assert [(r.c, r.j) for r in rows] == [("NaN", None), ("inf", None), ("-inf", None), (None, None)]


@settings(max_examples=500, deadline=None)
@given(st.floats(allow_nan=False, allow_infinity=False))
def test_number_text_round_trips(value):
    bits = struct.pack("d", value)
    for text in (N.csv_text(value), N.json_text(value)):
        assert struct.pack("d", float(text)) == bits
    assert "e" not in N.csv_text(value)


def test_arrow_rendering_matches_reference_function(spark):
    import random

    rng = random.Random(7)
    values = [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-9, 18) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    rows = df.select("v", N.csv_number("v").alias("c"), N.json_number("v").alias("j")).collect()
    assert [(r.c, r.j) for r in rows] == [(N.csv_text(r.v), N.json_text(r.v)) for r in rows]
