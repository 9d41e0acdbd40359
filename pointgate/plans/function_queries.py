"""Queries of the column functions: each table row is rendered as text and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.functions import times
from pointgate.functions.json import string_or_null, with_json_fields
from pointgate.functions.numbers import csv_number, json_number, strict_double
from pointgate.plans.fixtures import pick, table, text
from pointgate.plans.registry import register

_EPOCH_MS = "epoch_us(ts) // 1000"


@register(
    "ts_epoch_units",
    f"""
SELECT event_id,
       ({_EPOCH_MS}) // 1000 * 1000000000 AS from_s,
       CAST(CAST({_EPOCH_MS} AS DOUBLE) * 1e6::DOUBLE AS BIGINT) AS from_ms,
       CAST(CAST(epoch_us(ts) * 1000 AS DOUBLE) AS BIGINT) AS from_ns,
       CAST((CAST({_EPOCH_MS} AS DOUBLE) / 1000.0::DOUBLE) * 1e9::DOUBLE AS BIGINT) AS from_ticks,
       event_id % 7 = 0 AS bad_is_null
FROM events
""",
)
def ts_epoch_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    ns = times.native_to_ns(F.col("ts"))
    ms = times.to_ms(ns).cast("string")
    bad = pick(F.col("event_id"), F.lit("-1"), *[ms] * 6)
    return events.select(
        "event_id",
        times.epoch_text_to_ns(F.call_function("div", times.to_ms(ns), F.lit(1000)).cast("string"), "s").alias("from_s"),
        times.epoch_text_to_ns(ms, "ms").alias("from_ms"),
        times.epoch_text_to_ns(ns.cast("string"), "ns").alias("from_ns"),
        times.epoch_text_to_ns(ms, "tick", 1000.0).alias("from_ticks"),
        times.epoch_text_to_ns(bad, "ms").isNull().alias("bad_is_null"),
    )


@register(
    "ts_datetime",
    """
SELECT event_id, epoch_us(ts) // 1000000 * 1000000000 AS whole, epoch_us(ts) * 1000 AS fraction,
       epoch_us(ts) * 1000 + 789 AS nanos, epoch_us(ts) // 60000000 * 60000000000 AS slashes,
       epoch_us(ts) // 1000000 * 1000000000 AS named,
       CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 0
            ELSE epoch_us(ts) // 1000000 * 1000000000 END AS defects
FROM events
""",
)
def ts_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    show = lambda pattern: F.date_format("ts", pattern)
    plain = show("yyyy-MM-dd HH:mm:ss")
    defects = pick(
        F.col("event_id"), text(show("yyyy-02-30 HH:mm:ss")), text(plain, "Z"), text(show("yyyy-MM-dd")), plain
    )
    return events.select(
        "event_id",
        times.datetime_to_ns(plain, "datetime_utc").alias("whole"),
        times.datetime_to_ns(show("yyyy-MM-dd HH:mm:ss.SSSSSS"), "datetime_utc_ms").alias("fraction"),
        times.datetime_to_ns(show("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'789'"), "%Y-%m-%dT%H:%M:%S%.f").alias("nanos"),
        times.datetime_to_ns(show("d/M/yyyy H:m"), "%d/%m/%Y %H:%M").alias("slashes"),
        times.datetime_to_ns(show("d MMM yyyy HH:mm:ss"), "%d %b %Y %T").alias("named"),
        F.coalesce(times.datetime_to_ns(defects, "datetime_utc"), F.lit(0)).alias("defects"),
    )


@register(
    "ts_week_dates",
    """
WITH e AS (SELECT event_id, epoch_us(ts) // 1000000 * 1000000000 AS ns FROM events)
SELECT event_id, ns AS iso, ns AS short_iso, ns AS sunday, ns AS monday, ns AS century,
       CASE WHEN event_id % 3 = 0 THEN 0 ELSE ns END AS defects
FROM e
""",
)
def ts_week_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates by week and weekday; every third has a weekday that contradicts its date."""
    events = table(spark, sf_dir, "events")
    day, clock = F.to_date("ts"), F.date_format("ts", "HH:mm:ss")
    weekday = F.weekday(day)  # Monday: 0
    iso_year = F.year(F.date_add(day, 3 - weekday))
    year, number = F.year(day), F.dayofyear(day)
    week = lambda first: F.floor((number + 6 - F.pmod(weekday - first, F.lit(7))) / 7)
    iso = text(iso_year, "-W", F.weekofyear(day), "-", weekday + 1, " ", clock)
    short = text(F.lpad((iso_year % 100).cast("string"), 2, "0"), " ", F.weekofyear(day), " ", weekday + 1, " ", clock)
    sunday = text(year, " ", week(6), " ", F.pmod(weekday + 1, F.lit(7)), " ", clock)
    monday = text(year, " ", week(0), " ", F.date_format(day, "EEEE"), " ", clock)
    century = text(F.floor(year / 100), F.date_format(day, "yy-MM-dd "), clock)
    told = F.pmod(weekday + F.when(F.pmod("event_id", F.lit(3)) == 0, 1).otherwise(0), F.lit(7)) + 1
    defects = text(F.date_format(day, "yyyy-MM-dd "), told, " ", clock)
    return events.select(
        "event_id",
        times.datetime_to_ns(iso, "%G-W%V-%u %T").alias("iso"),
        times.datetime_to_ns(short, "%g %V %u %T").alias("short_iso"),
        times.datetime_to_ns(sunday, "%Y %U %w %T").alias("sunday"),
        times.datetime_to_ns(monday, "%Y %W %A %T").alias("monday"),
        times.datetime_to_ns(century, "%C%y-%m-%d %T").alias("century"),
        F.coalesce(times.datetime_to_ns(defects, "%Y-%m-%d %u %T"), F.lit(0)).alias("defects"),
    )


@register(
    "ts_time_of_day",
    """
SELECT event_id, epoch_us(ts) % 86400000000 * 1000 + epoch_us(TIMESTAMP '2024-03-05') * 1000 AS with_fraction,
       epoch_us(ts) // 1000000 % 86400 * 1000000000 + epoch_us(TIMESTAMP '2024-03-05') * 1000 AS whole
FROM events
""",
)
def ts_time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.datetime_to_ns(F.date_format("ts", "HH:mm:ss.SSSSSS"), "time_utc", "2024-03-05").alias("with_fraction"),
        times.datetime_to_ns(F.date_format("ts", "HH:mm:ss"), "time_utc", "2024-03-05").alias("whole"),
    )


@register(
    "strict_double",
    """
SELECT l_orderkey, l_linenumber,
       CASE (l_orderkey + l_linenumber) % 12
            WHEN 0 THEN l_extendedprice WHEN 1 THEN -l_extendedprice WHEN 2 THEN l_extendedprice
            WHEN 3 THEN l_quantity WHEN 4 THEN l_discount WHEN 5 THEN l_quantity * 1000.0::DOUBLE
            ELSE CASE WHEN (l_orderkey + l_linenumber) % 12 = 11 THEN 'inf'::DOUBLE END END AS parsed
FROM lineitem
""",
)
def strict_double_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good spellings, then ones a plain cast would let through.  Odd keys (null, or below zero) have no spelling."""
    price, quantity = F.col("l_extendedprice").cast("string"), F.col("l_quantity").cast("string")
    size = F.ltrim(price, F.lit("-"))  # the price without its sign
    spellings = [
        price,
        F.when(F.startswith(price, F.lit("-")), size).otherwise(text("-", price)),
        F.when(F.startswith(price, F.lit("-")), price).otherwise(text("+", price)),
        F.regexp_replace(quantity, r"\.0\z", "."),
        F.regexp_replace(F.col("l_discount").cast("string"), r"\A0\.", "."),
        # the exponent says the same only of whole numbers that are printed without one
        F.when(quantity.rlike(r"\A-?\d+\.0\z"), text(quantity, "e+3")).otherwise(
            (F.col("l_quantity") * 1000.0).cast("string")
        ),
        text(price, "d"),
        text(" ", price),
        text("0x", F.hex("l_orderkey"), "p3"),
        text(price, " "),
        F.lit(""),
        F.lit("+Infinity"),
    ]
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % len(spellings)
    spelled = F.coalesce(*[F.when(kind == i, spelling) for i, spelling in enumerate(spellings)])
    parsed = strict_double(spelled)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", parsed.alias("parsed"))


@register(
    "json_path",
    """
SELECT event_id, value AS nested, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS in_list, value AS numeric_key,
       value + 1 AS spaced, event_id % 2 = 0 AS flag_is_null, 1 AS absent_is_null, event_type AS word
FROM events
""",
)
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    body = text(
        '{"a":{"b":', value, '},"l":[{"p":', F.col("props"), '}],"n":{"0":"', value, '"},"with space":',
        value + 1, ',"flag":', pick(F.col("event_id"), F.lit("true"), value.cast("string")), ',"w":"', F.col("event_type"), '"}',
    )
    paths = {
        "nested": "a.b",
        "in_list": "l.0.p.k",
        "numeric_key": "n.0",
        "spaced": "with space",
        "flag": "flag",
        "absent": "a.c",
    }
    events = with_json_fields(table(spark, sf_dir, "events"), body, paths, {"word": "w"})
    get = lambda name: strict_double(F.col(name))
    return events.select(
        "event_id",
        *[get(name).alias(name) for name in ("nested", "in_list", "numeric_key", "spaced")],
        get("flag").isNull().alias("flag_is_null"),
        get("absent").isNull().cast("int").alias("absent_is_null"),
        string_or_null(F.col("word")).alias("word"),
    )


@register(
    "csv_number_text",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity AS quantity,
       regexp_replace(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR), '\\.?0+$', '') AS price_text,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity_text,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0' AS quantity_json,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || repeat('0', 20) AS big_text,
       l_extendedprice / 3.0::DOUBLE AS third
FROM lineitem
""",
)
def csv_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of the CSV and JSON sinks; ``third`` is a number with many digits, printed and read back."""
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        csv_number(price).cast("double").alias("price"),
        json_number(quantity).cast("double").alias("quantity"),
        csv_number(price).alias("price_text"),
        csv_number(quantity).alias("quantity_text"),
        json_number(quantity).alias("quantity_json"),
        csv_number(F.concat(quantity.cast("bigint").cast("string"), F.lit("e20")).cast("double")).alias("big_text"),
        csv_number(price / F.lit(3.0)).cast("double").alias("third"),
    )
