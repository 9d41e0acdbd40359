from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from pointgate.functions import times as T
from pointgate.functions.numbers import BIGINT_MAX


def ns(*parts, extra=0):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp()) * 10**9 + extra


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}").coalesce(1)


@pytest.mark.parametrize(
    "fmt,text,want",
    [
        ("datetime_utc", "2024-01-05 10:11:12", ns(2024, 1, 5, 10, 11, 12)),
        ("datetime_utc", "2024-1-5 1:2:3", ns(2024, 1, 5, 1, 2, 3)),
        ("datetime_utc", "  2024-01-05 10:11:12 ", ns(2024, 1, 5, 10, 11, 12)),
        ("datetime_utc", "2024-01-05 10:11:12.5", None),
        ("datetime_utc", "2024-01-05T10:11:12", None),
        ("datetime_utc", "2024-02-30 10:11:12", None),
        ("datetime_utc", "2024-01-05 25:11:12", None),
        ("datetime_utc", "2024-01-05", None),
        ("datetime_utc", "", None),
        ("datetime_utc_ms", "2024-01-05 10:11:12", ns(2024, 1, 5, 10, 11, 12)),
        ("datetime_utc_ms", "2024-01-05 10:11:12.123456789", ns(2024, 1, 5, 10, 11, 12, extra=123456789)),
        ("datetime_utc_ms", "2024-01-05 10:11:12.1234567891", ns(2024, 1, 5, 10, 11, 12, extra=123456789)),
        ("datetime_utc_ms", "2024-01-05 10:11:12.", None),
        ("datetime_utc_ms", "1969-12-31 23:59:59", -(10**9)),
        ("datetime_utc", "2300-01-01 00:00:00", None),
        ("%H:%M:%S on %d.%m.%Y", "05:06:07 on 04.03.2024", ns(2024, 3, 4, 5, 6, 7)),
        ("%m|%d|%Y %H.%M.%S", "12|31|2031 23.59.58", ns(2031, 12, 31, 23, 59, 58)),
        ("y%Y m%m d%d h%H m%M s%S", "y1999 m01 d02 h03 m04 s05", ns(1999, 1, 2, 3, 4, 5)),
        ("%S%.3f s, %H:%M, %d/%m/%Y", "07.250 s, 05:06, 04/03/2024", ns(2024, 3, 4, 5, 6, 7, extra=250_000_000)),
        ("%D %I:%M %p", "07/04/68 12:30 am", ns(2068, 7, 4, 0, 30)),
        ("%D %r", "07/04/99 01:02:03 PM", ns(1999, 7, 4, 13, 2, 3)),
        ("%D %r", "07/04/99 13:02:03 PM", None),
        ("%Y/%j %R", "2024/366 23:59", ns(2024, 12, 31, 23, 59)),
        ("%Y/%j %R", "2023/366 23:59", None),
        ("%s", "1700000000", 1_700_000_000_000_000_000),
        ("%s", "99999999999999999999", None),
        ("%a, %d %h %Y %T", "Fri, 05 Jan 2024 10:11:12", ns(2024, 1, 5, 10, 11, 12)),
        ("%A%t%F%n%T", "friday 2024-01-05 10:11:12", ns(2024, 1, 5, 10, 11, 12)),
        ("%a, %d %h %Y %T", "Mon, 05 Jan 2024 10:11:12", None),
        ("%a, %d %h %Y %T", "soon", None),
        ("%FT%TZ", "2024-03-04T05:06:07Z", ns(2024, 3, 4, 5, 6, 7)),
        ("%d %B %Y %R", "4 March 2024 05:06", ns(2024, 3, 4, 5, 6)),
        ("%b %e %Y %T", "mar  4 2024 05:06:07", ns(2024, 3, 4, 5, 6, 7)),
    ],
)
def test_datetime(spark, fmt, text, want):
    assert column(spark, [text]).select(T.datetime_to_ns(F.col("v"), fmt)).first()[0] == want


def test_time_of_day(spark):
    rows = column(spark, ["00:00:00.0140000", "23:59:59", "24:00:00", "x"]).select(
        T.datetime_to_ns(F.col("v"), "time_utc", "2024-01-05")
    )
    assert [r[0] for r in rows.collect()] == [ns(2024, 1, 5, extra=14_000_000), ns(2024, 1, 5, 23, 59, 59), None, None]


@pytest.mark.parametrize("fmt", ["%q", "%Y-%m-%d", "%H:%M:%S"])
def test_unsupported_format(spark, fmt):
    with pytest.raises(ValueError):
        T.datetime_to_ns(F.col("v"), fmt)


@pytest.mark.parametrize(
    "unit,text,want",
    [
        ("s", "1.5", 1_500_000_000),
        ("ms", "1700000000000", 1_700_000_000_000_000_000),
        ("ms", "0.5", 500_000),
        # Goes through a double: the last digits are lost.
        ("ns", "1700000000000000001", 1_700_000_000_000_000_000),
        ("ns", "1.9", 1),
        ("tick", "128", 2_000_000_000),
        ("ms", "-1", None),
        ("ms", "nan", None),
        ("ms", "inf", None),
        ("ms", "1d", None),
        ("s", "1e300", BIGINT_MAX),
    ],
)
def test_epoch_units(spark, unit, text, want):
    assert column(spark, [text]).select(T.epoch_text_to_ns(F.col("v"), unit)).first()[0] == want


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        T.epoch_text_to_ns(F.col("v"), "h")


def test_rfc3339(spark):
    cases = {
        "2024-01-05T10:11:12Z": ns(2024, 1, 5, 10, 11, 12),
        "2024-01-05t10:11:12.123456789z": ns(2024, 1, 5, 10, 11, 12, extra=123456789),
        "2024-01-05T10:11:12+01:30": ns(2024, 1, 5, 8, 41, 12),
        "2024-01-05T10:11:12": None,
        "2024-13-05T10:11:12Z": None,
        "-": None,
        "": None,
    }
    rows = column(spark, cases).select("v", T.rfc3339_to_ns(F.col("v")).alias("n")).collect()
    assert {r.v: r.n for r in rows} == cases


def test_whole_milliseconds(spark):
    rows = column(spark, [5, None, 2**62], "bigint").select(T.whole_ms_to_ns(F.col("v"))).collect()
    assert [r[0] for r in rows] == [5_000_000, None, BIGINT_MAX // 10**6 * 10**6]


def test_exact_division_near_midnight(spark):
    last = ns(2024, 1, 5) - 1
    row = column(spark, [last], "bigint").select(
        T.utc_day(F.col("v")).cast("string").alias("d"), T.to_ms(F.col("v")).alias("ms"), T.event_time(F.col("v")).alias("t")
    ).first()
    assert row.d == "2024-01-04"
    assert row.ms == last // 10**6
    assert row.t.microsecond == 999_999


@pytest.mark.parametrize(
    "fmt",
    ["%G-W%V-%u %H:%M:%S", "%G %V %A %T", "%Y %U %w %T", "%Y %W %u %T", "%Y %W %a %T", "%C%y-%m-%d %T",
     "%Y-%m-%d %u %w %j %U %W %V %G %T", "%g %V %u %T"],
)
def test_week_dates(spark, fmt):
    years = range(1970, 2060)
    days = [datetime(y, m, d, 1, 2, 3) for y in years for m, d in ((1, 1), (1, 4), (7, 9), (12, 28), (12, 31))]
    days = [d for d in days if not fmt.startswith("%g") or 1970 <= d.isocalendar()[0] < 2069]
    rows = [(d.strftime(fmt), int(d.replace(tzinfo=timezone.utc).timestamp()) * 10**9) for d in days]
    df = spark.createDataFrame(rows, "text string, want long").withColumn("got", T.datetime_to_ns(F.col("text"), fmt))
    assert df.filter(~F.col("got").eqNullSafe(F.col("want"))).take(1) == []


def test_week_dates_that_contradict(spark):
    cases = [
        ("2024-01-05 3", "%Y-%m-%d %u"), ("2024 54 1", "%G %V %u"), ("2021 53 1", "%G %V %u"), ("2024 00 0", "%Y %U %w"),
        ("2024 0 1", "%Y %W %u"), ("20 25 2024-01-05", "%C %y %Y-%m-%d"), ("2024-01-05 7", "%Y-%m-%d %V"),
    ]
    for text, fmt in cases:
        moment = T.datetime_to_ns(F.lit(f"{text} 00:00:00"), f"{fmt} %T")
        assert spark.range(1).select(moment).first()[0] is None, (text, fmt)
    for fmt in ("%G %V %T", "%V %u %T", "%U %w %T", "%C-%m-%d %T"):
        with pytest.raises(ValueError):
            T.datetime_to_ns(F.lit(""), fmt)


def test_parts_use_the_text_once(spark):
    """Each use repeated the text's own computation: the plan grew beyond what compiles."""
    df = spark.createDataFrame([("2024-W02-3 04:05:06",), ("2024-W02-8 04:05:06",), (None,)], "words string")
    got = df.select(T.datetime_to_ns(F.concat("words", F.lit("")), "%G-W%V-%u %T").alias("ns"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(words") <= 1
    assert [r.ns for r in got.collect()] == [1_704_859_506_000_000_000, None, None]
