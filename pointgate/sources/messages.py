"""Message tables and streams: Kafka-shaped rows, landed raw messages, landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.functions import json as J
from pointgate.functions import times
from pointgate.functions.json import with_json_fields
from pointgate.functions.numbers import strict_double
from pointgate.operators import normalize as N
from pointgate.operators import points as P
from pointgate.operators.limits import limit_pages
from pointgate.options import PathMapping
from pointgate.session import staged

KAFKA_ORDER = ("topic", "partition", "offset")


def read_kafka(spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options) -> DataFrame:
    """A topic from its beginning.  Needs Spark's Kafka package on the class path."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for name, value in {"startingOffsets": "earliest", **options}.items():
        reader = reader.option(name, value)
    return reader.load()


def decode_kafka(df: DataFrame, mapping: PathMapping, as_of_ms: int | None = None) -> DataFrame:
    """Rows ``(key, value BINARY, topic, partition, offset, timestamp)`` -> points.

    Null values are skipped; bytes that are no UTF-8 are rejected with an empty raw text.
    """
    text = F.col("value").cast("string")
    df = df.filter(F.col("value").isNotNull()).withColumn("__utf8", F.is_valid_utf8(text))
    df = df.withColumn("__raw", F.when(F.col("__utf8"), text).otherwise(F.lit("")))
    wrong = F.when(~F.col("__utf8"), F.lit("invalid UTF-8"))
    points = N.normalize_json_paths(df, "__raw", mapping, as_of_ms, error_before=wrong)
    return points.select(*KAFKA_ORDER, *P.POINT_COLUMNS)


def read_landed(
    spark: SparkSession, path: str, streaming: bool = False, form: str = "text", schema: str | None = None, **options
) -> DataFrame:
    """Raw messages landed as files, as a table or a stream.  Text files give one message per line in ``raw``."""
    reader = (spark.readStream if streaming else spark.read).format(form)
    for name, value in options.items():
        reader = reader.option(name, value)
    if form == "text":
        return reader.load(path).withColumnRenamed("value", "raw")
    return (reader.schema(schema) if schema else reader).load(path)


def decode_datagrams(
    df: DataFrame, mapping: PathMapping, raw: str = "raw", as_of_ms: int | None = None
) -> DataFrame:
    """One JSON payload per datagram -> points; empty ones are skipped, invalid UTF-8 is rejected."""
    df = df.filter(F.octet_length(raw) > 0)
    bad = F.when(~F.is_valid_utf8(F.col(raw)), F.lit("invalid UTF-8"))
    return N.normalize_json_paths(df, raw, mapping, as_of_ms, error_before=bad)


def _page_items(body: Column, ok: Column, is_list: Column) -> Column:
    return (
        F.when(~ok, F.array(body))
        .when(is_list, F.from_json(body, "array<string>"))
        .otherwise(F.array(body))
    )


def decode_pages(
    df: DataFrame,
    mapping: PathMapping,
    page: str = "page_no",
    body: str = "body",
    cursor_path: str | None = None,
    max_pages: int | None = None,
    as_of_ms: int | None = None,
) -> DataFrame:
    """Landed page bodies -> points of all pages a pager would have visited.

    An array body is one record per element, any other body one record.  Visiting ends before the first page
    without a good record, and with the first page whose cursor is not a string (when ``cursor_path`` is set).
    Columns ``next_cursor`` and ``item_no`` are added.  The points are staged (``session.scratch`` says when they go).
    """
    values = {} if cursor_path is None else {"__cursor": cursor_path}
    pages = with_json_fields(limit_pages(df, max_pages, page), F.col(body), values=values, ok="__valid")
    cursor = F.lit(None).cast("string") if cursor_path is None else J.string_or_null(F.col("__cursor"))
    # The first character of a valid document tells a list from anything else.
    listed = F.regexp_extract(body, r"\A\s*(\S)", 1) == "["
    pages = pages.withColumns({"next_cursor": cursor, "__list": listed})
    items = _page_items(F.col(body), F.col("__valid"), F.coalesce("__list", F.lit(False)))
    exploded = pages.select(
        page, "next_cursor", F.posexplode_outer(items).alias("item_no", "__item")
    )
    points = N.normalize_json_paths(exploded, "__item", mapping, as_of_ms)
    # Decoded once: the stop rule and the result read this copy.
    points = staged(points.select(page, "item_no", "next_cursor", *P.POINT_COLUMNS), "pages")
    # An empty array leaves one row without an item: it counts for the stop rule only.
    per_page = points.groupBy(page).agg(
        F.count_if(F.col("error_code").isNull() & F.col("raw").isNotNull()).alias("good"),
        F.max("next_cursor").alias("next_cursor"),
    )
    first_bad = F.min(F.when(F.col("good") == 0, F.col(page)))
    last = F.lit(None).cast("bigint")
    if cursor_path is not None:
        last = F.min(F.when(F.col("next_cursor").isNull(), F.col(page)))
    ends = per_page.agg(first_bad.alias("stop"), last.alias("last"))
    end = ends.select(F.struct("stop", "last")).scalar()
    stop, final = end["stop"], end["last"]
    visited = (stop.isNull() | (F.col(page) < stop)) & (final.isNull() | (F.col(page) <= final))
    return points.filter(visited & F.col("raw").isNotNull()).select(
        page, "item_no", "next_cursor", *P.POINT_COLUMNS
    )


# One CSV cell: quoted (quotes doubled) or plain.
_CELL = r'(?:^|,)(?:"(?:[^"]++|"")*+"|[^,"]*+)'
# A record ends at a line break outside quotes.
_RECORD = r'(?:[^"\r\n]++|"(?:[^"]++|"")*+")*+'


def _cells(record: Column) -> Column:
    found = F.regexp_extract_all(record, F.lit(_CELL), F.lit(0))

    def clean(cell: Column, position: Column) -> Column:
        cell = F.when(position > 0, F.substr(cell, F.lit(2))).otherwise(cell)
        quoted = cell.rlike(r'(?s)\A".*"\z')
        inner = F.replace(F.substr(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        return F.when(quoted, inner).otherwise(cell)

    return F.transform(found, clean)


def decode_csv_bodies(
    df: DataFrame, field_paths: list[str], body: str = "body", as_of_ms: int | None = None
) -> DataFrame:
    """Bodies that are CSV texts -> one point each: the first data row, columns by header name, time is now."""
    lines = r"(?s)\A[\r\n]*(" + _RECORD + r")(?:[\r\n]+(" + _RECORD + r"))?.*\z"
    df = df.withColumns(
        {
            "__head": _cells(F.regexp_extract(body, lines, 1)),
            "__line": F.regexp_extract(body, lines, 2),
        }
    ).withColumn("__row", _cells(F.col("__line")))
    checks: list[tuple[Column, Column | str]] = []
    staged = {}
    for i, path in enumerate(field_paths):
        place = F.array_position("__head", path)
        checks.append((place == 0, f"Missing Field: column '{path}' not found"))
        staged[f"__m{i}"] = strict_double(F.get("__row", (place - 1).cast("int")))
    checks.append((F.col("__line") == "", "no data row"))
    checks.append((F.size("__row") != F.size("__head"), "CSV parse error"))
    checks += [(F.col(name).isNull(), "invalid numeric value") for name in staged]
    return P.with_point(
        df.withColumns(staged),
        times.as_of_ns(as_of_ms),
        F.array(*staged),
        F.col(body),
        parse_error=P.first_error(*checks),
        drop=("__head", "__line", "__row", *staged),
    )
