"""Queries of the file sources: events, orders and lineitem are written as files in each format and read back.

Records get defects by their key; none is left out.
"""

from __future__ import annotations

import gzip
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.functions.times import native_to_ns
from pointgate.operators.counts import counts_per_file
from pointgate.operators.gate import apply_checks
from pointgate.operators.normalize import normalize_columns, normalize_csv, normalize_json_map
from pointgate.operators.points import metric_columns, output_columns
from pointgate.options import Bound, GateOptions, OutputOptions, PointMapping, TimeSpec
from pointgate.plans.fixtures import AS_OF_MS, ms, pick, table, text, write_lines
from pointgate.plans.folder import run_folder
from pointgate.plans.registry import register
from pointgate.session import scratch_path
from pointgate.sources import cursor as resume
from pointgate.sources.files import (
    csv_file_points,
    csv_points,
    directory_points,
    json_points,
    parquet_points,
    passthrough_lines,
    read_csv,
    read_json,
    read_jsonl,
    read_parquet,
)

AS_OF_NS = AS_OF_MS * 1_000_000
HEADER = "event_id,ts_ms,price,volume"
MAPPING = PointMapping({"price": 0, "volume": 1}, 2, TimeSpec(field="ts_ms", unit="ms"))

_MS = "epoch_us(ts) // 1000"
_NS = f"CAST(CAST({_MS} AS DOUBLE) * 1e6::DOUBLE AS BIGINT)"
_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
_KT = "json_extract_string(props, '$.k')"


def shown(df: DataFrame, *more: str | Column) -> DataFrame:
    return df.select(
        *more,
        F.coalesce("timestamp_ns", F.lit(-1)).alias("timestamp_ns"),
        *metric_columns(["metric_0", "metric_1"]),
        "error_code",
        "raw",
    )


def _event_lines(spark: SparkSession, sf_dir: str, sep: str = ",") -> DataFrame:
    """One delimited line per event, 11 kinds; ``line`` may be blank."""
    events = table(spark, sf_dir, "events")
    v, k = F.col("value").cast("string"), F.get_json_object("props", "$.k")

    def row(price: Column, moment: Column | None = None, *rest: str | Column) -> Column:
        moment = ms("ts").cast("string") if moment is None else moment
        return text(F.col("event_id"), sep, moment, sep, price, sep, k, *rest)

    line = pick(
        F.col("event_id"),
        row(v),
        row(v, None, sep, "extra"),
        row(text(v, "d")),
        row(F.lit("0x1p3")),
        row(F.lit("")),
        row(text("  ", v, " ")),
        row(v, F.lit("soon")),
        F.lit(sep * 3),
        F.lit(""),
        row(text('"', v, '"')),
        row(v, text(ms("ts"), ".5")),
    )
    return events.select(line.alias("line"))


def _csv_sql(padded_ok: bool, sep: str, strict_time: str = "") -> str:
    """Expected points of ``_event_lines``."""
    good = "0, 5, 9, 10" if padded_ok else "0, 9, 10"
    price = f"""CASE kind WHEN 2 THEN v || 'd' WHEN 3 THEN '0x1p3' WHEN 4 THEN ''
                WHEN 5 THEN {"v" if padded_ok else "'  ' || v || ' '"} ELSE v END"""
    moment = "CASE kind WHEN 6 THEN 'soon' WHEN 10 THEN t || '.5' ELSE t END"
    broken = "''" if padded_ok else f"id || '{sep}' || t || '{sep}' || v || '{sep}' || k || '{sep}extra'"
    return f"""
WITH l AS (
  SELECT event_id % 11 AS kind, CAST(event_id AS VARCHAR) AS id, CAST({_MS} AS VARCHAR) AS t,
         CAST(value AS VARCHAR) AS v, {_KT} AS k, value, {_K} AS m1, {_MS} AS ms
  FROM events)
SELECT CASE WHEN kind NOT IN ({good}) THEN -1
            WHEN kind = 10 THEN CAST((CAST(ms AS DOUBLE) + 0.5::DOUBLE) * 1e6::DOUBLE AS BIGINT)
            ELSE CAST(CAST(ms AS DOUBLE) * 1e6::DOUBLE AS BIGINT) END AS timestamp_ns,
       CASE WHEN kind IN ({good}) THEN value END AS metric_0, CASE WHEN kind IN ({good}) THEN m1 END AS metric_1,
       CASE WHEN kind = 1 THEN 'CSV_READ_ERROR' WHEN kind NOT IN ({good}) THEN 'PARSE_ERROR' END AS error_code,
       CASE WHEN kind = 1 THEN {broken} ELSE id || '|' || {moment} || '|' || {price} || '|' || k END AS raw
FROM l WHERE kind NOT IN (7, 8)
"""


@register("csv_scan", _csv_sql(True, ","))
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_event_lines(spark, sf_dir), "csv", HEADER, "csv")
    return shown(csv_points(read_csv(spark, path), MAPPING, as_of_ms=AS_OF_MS))


@register("tsv_scan", _csv_sql(False, "\t"))
def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells are not trimmed here, and unreadable records keep their text."""
    path = write_lines(_event_lines(spark, sf_dir, "\t"), "tsv", HEADER.replace(",", "\t"), "tsv")
    cells = read_csv(spark, path, sep="\t", trim=False)
    return shown(csv_points(cells, MAPPING, strict=False, as_of_ms=AS_OF_MS, keep_unreadable=True))


@register(
    "csv_mixed_headers",
    f"""
WITH l AS (
  SELECT event_id % 4 AS kind, CAST(event_id AS VARCHAR) AS id, CAST({_MS} AS VARCHAR) AS t,
         CAST(value AS VARCHAR) AS v, {_KT} AS k, value, {_K} AS m1, {_NS} AS ns
  FROM events)
SELECT CASE WHEN kind = 3 THEN -1 ELSE ns END AS timestamp_ns, CASE WHEN kind < 3 THEN value END AS metric_0,
       CASE WHEN kind < 3 THEN m1 END AS metric_1, CASE WHEN kind = 3 THEN 'PARSE_ERROR' END AS error_code,
       CASE kind WHEN 0 THEN id || '|' || t || '|' || v || '|' || k WHEN 1 THEN k || '|' || v || '|' || t || '|' || id
                 WHEN 2 THEN id || '|x|' || t || '|' || v || '|' || k ELSE id || '|' || t || '|' || v END AS raw
FROM l
""",
)
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with reordered, additional and missing columns in one folder."""
    root = scratch_path(spark, "headers")
    fields = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        ms("ts").cast("string").alias("ts_ms"),
        F.col("value").cast("string").alias("price"),
        F.get_json_object("props", "$.k").alias("volume"),
        F.lit("x").alias("other"),
        F.pmod("event_id", F.lit(4)).alias("kind"),
    )
    shapes = (HEADER.split(","), ["volume", "price", "ts_ms", "event_id"],
              ["event_id", "other", "ts_ms", "price", "volume"], ["event_id", "ts_ms", "price"])
    for kind, names in enumerate(shapes):
        fields.filter(F.col("kind") == kind).select(*names).write.option("header", True).csv(f"{root}/{kind}")
    return shown(csv_file_points(spark, root, MAPPING, as_of_ms=AS_OF_MS, recursiveFileLookup=True))


def _with_head(df: DataFrame, lines: list[str], root: str) -> None:
    """Write one-column text rows as files that each begin with ``lines``."""

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["line"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["line"])

    df.toDF("line").mapInArrow(run, "line string").write.option("lineSep", "\n").text(root)


@register(
    "csv_odd_heads",
    f"""
SELECT CASE event_id % 5 WHEN 0 THEN 'blank' WHEN 1 THEN 'mark' WHEN 2 THEN 'break' WHEN 3 THEN 'comment'
       ELSE 'wide' END AS head, {_NS} AS timestamp_ns, value AS metric_0, {_K} AS metric_1, CAST(NULL AS VARCHAR) AS error_code
FROM events
""",
)
def csv_odd_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers after blank lines, behind a byte order mark, with a quoted line break, after comments, and in UTF-16."""
    root = scratch_path(spark, "heads")
    fields = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        ms("ts").cast("string").alias("ts_ms"),
        F.col("value").cast("string").alias("price"),
        F.get_json_object("props", "$.k").alias("volume"),
        F.pmod("event_id", F.lit(5)).alias("kind"),
    )
    names = HEADER.split(",")
    line = F.concat_ws(",", *names)
    heads = {
        "blank": ["", "   ", "", HEADER], "mark": ["\ufeff" + HEADER], "break": ['"event', 'id",ts_ms,price,volume'],
        "comment": ["# made of events", '# "quoted', "", HEADER],
    }
    for kind, (name, head) in enumerate(heads.items()):
        _with_head(fields.filter(F.col("kind") == kind).select(line), head, f"{root}/{name}")
    wide = fields.filter("kind = 4").select(*names)
    wide.write.option("header", True).option("encoding", "UTF-16").csv(f"{root}/wide")

    def points(name: str, **options) -> DataFrame:
        made = csv_file_points(spark, f"{root}/{name}", MAPPING, as_of_ms=AS_OF_MS, **options)
        return shown(made, F.lit(name).alias("head")).drop("raw")

    parts = [points(n) for n in ("blank", "mark", "break")]
    parts += [points("comment", comment="#"), points("wide", encoding="UTF-16")]
    return reduce(DataFrame.union, parts)


_STRICT = GateOptions(future_tolerance_ms=0, stale_tolerance_ms=0, replay_mode=True, price_max=400.0)


@register(
    "parse_error_routing",
    f"""
WITH p AS (SELECT timestamp_ns, metric_0, metric_1, error_code, raw FROM ({_csv_sql(True, ",")}))
SELECT timestamp_ns, raw,
       CASE WHEN error_code IS NOT NULL OR metric_0 > 400.0 THEN 'rejected' ELSE 'accepted' END AS status,
       coalesce(error_code, CASE WHEN metric_0 > 400.0 THEN 'ABOVE_MAX' END) AS reason_code
FROM p
""",
)
def parse_error_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_event_lines(spark, sf_dir), "csv", HEADER, "csv")
    points = csv_points(read_csv(spark, path), MAPPING, as_of_ms=AS_OF_MS)
    judged = apply_checks(points, _STRICT, AS_OF_MS, 2)
    return judged.select(F.coalesce("timestamp_ns", F.lit(-1)).alias("timestamp_ns"), "raw", "status", "reason_code")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as string cells, some bad."""
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("string")
    return orders.select(
        "o_orderkey",
        pick(F.col("o_orderkey"), price, price, text(price, "f"), price).alias("price"),
        F.col("o_custkey").cast("string").alias("volume"),
        pick(
            F.col("o_orderkey"),
            *[F.date_format("o_orderdate", p) for p in ("yyyy-MM-dd HH:mm:ss", "yyyy-M-d H:m:s", "yyyy-MM-dd HH:mm:ss")],
            F.lit("1969-12-31 23:59:59"),
        ).alias("at"),
    )


_O_NS = "epoch_us(o_orderdate) * 1000"


def _orders_sql(good: str, metrics: list[str]) -> str:
    slots = ", ".join(f"CASE WHEN {good} THEN CAST({m} AS DOUBLE) END AS metric_{i}" for i, m in enumerate(metrics))
    return f"""
SELECT o_orderkey, CASE WHEN {good} THEN {_O_NS} ELSE -1 END AS timestamp_ns, {slots},
       CASE WHEN NOT ({good}) THEN 'PARSE_ERROR' END AS error_code
FROM orders
"""


def _orders_shown(points: DataFrame, metrics: int) -> DataFrame:
    names = [f"metric_{i}" for i in range(metrics)]
    moment = F.coalesce("timestamp_ns", F.lit(-1)).alias("timestamp_ns")
    return points.select("o_orderkey", moment, *metric_columns(names), "error_code")


_AT = TimeSpec(field="at", format="datetime_utc")


@register("normalize_csv_strict", _orders_sql("o_orderkey % 4 < 2", ["o_custkey", "o_totalprice"]))
def csv_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = PointMapping({"price": 1, "volume": 0}, 2, _AT)
    points = normalize_csv(_cells(spark, sf_dir), mapping, ["price", "volume", "at"], True, AS_OF_MS)
    return _orders_shown(points, 2)


@register("normalize_csv_lenient", _orders_sql("o_orderkey % 4 < 2", ["0.0", "o_totalprice", "0.0"]))
def csv_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics no field is mapped to are 0.0."""
    points = normalize_csv(
        _cells(spark, sf_dir), PointMapping({"price": 1}, 3, _AT), ["price", "volume", "at"], False, AS_OF_MS
    )
    return _orders_shown(points, 3)


@register("legacy_two_field", _orders_sql("o_orderkey % 4 < 2", ["o_totalprice", "o_custkey"]))
def legacy_two_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = PointMapping.from_config(
        {"price_field": "price", "volume_field": "volume", "timestamp_field": "at", "timestamp_format": "datetime_utc"}
    )
    points = normalize_csv(_cells(spark, sf_dir), mapping, ["price", "volume", "at"], True, AS_OF_MS)
    return _orders_shown(points, 2)


_JSON_GOOD = "event_id % 9 IN (0, 1, 2, 3)"
_JSON_NS = f"CASE event_id % 9 WHEN 2 THEN epoch_us(ts) * 1000 WHEN 3 THEN {AS_OF_NS} WHEN 1 THEN CAST((CAST({_MS} AS DOUBLE) + 0.25::DOUBLE) * 1e6::DOUBLE AS BIGINT) ELSE {_NS} END"
_JSON_SQL = f"""
SELECT event_id, CASE WHEN {_JSON_GOOD} THEN {_JSON_NS} ELSE -1 END AS timestamp_ns,
       CASE WHEN {_JSON_GOOD} THEN value END AS metric_0, CASE WHEN {_JSON_GOOD} THEN {_K} END AS metric_1,
       CASE WHEN NOT ({_JSON_GOOD}) THEN 'PARSE_ERROR' END AS error_code
FROM events
"""
_JSON_MAPPING = PointMapping({"m.v": 0, "p.k": 1}, 2, TimeSpec(field="t", format="%Y-%m-%dT%H:%M:%S%.f"))


def _event_json(spark: SparkSession, sf_dir: str, broken: bool = True) -> DataFrame:
    """One JSON record per event, 9 kinds: good ones, then broken ones (never cut off with ``broken`` off)."""
    v, p = F.col("value"), F.col("props")
    head = text('{"id":', F.col("event_id"), ",")
    words = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = pick(
        F.col("event_id"),
        text(head, '"m":{"v":', v, '},"p":', p, ',"t":', ms("ts"), "}"),
        text(head, '"m":{"v":"', v, '"},"p":', p, ',"t":"x","t":', ms("ts"), ".25}"),
        text(head, '"m":{"v":', v, '},"p":', p, ',"t":"', words, '"}'),
        text(head, '"m":{"v":', v, '},"p":', p, "}"),
        text(head, '"m":{"v":', v, '},"t":', ms("ts"), "}"),
        text(head, '"m":{"v":true},"p":', p, ',"t":', ms("ts"), "}"),
        text(head, '"m":{"v":"nan"},"p":', p, ',"t":', ms("ts"), "}"),
        text(head, '"m":{"v":', v, '},"p":', p, ',"t":-1}'),
        text(head, '"m":{"v":', v, "}" if not broken else "", "}" if not broken else '},"p":'),
    )
    return table(spark, sf_dir, "events").select("event_id", body.alias("raw"))


@register("normalize_json_map", _JSON_SQL)
def json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = normalize_json_map(_event_json(spark, sf_dir), "raw", _JSON_MAPPING, AS_OF_MS)
    return shown(points, "event_id").drop("raw")


def _with_id(points: DataFrame) -> DataFrame:
    found = F.regexp_extract("raw", r'"id":(\d+)', 1).cast("bigint")
    return shown(points, found.alias("event_id")).drop("raw")


@register("jsonl_scan", _JSON_SQL)
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is followed by a blank line, which is skipped."""
    lines = _event_json(spark, sf_dir).select(text(F.col("raw"), "\n  \t").alias("raw"))
    path = write_lines(lines, "jsonl")
    return _with_id(json_points(read_jsonl(spark, path), _JSON_MAPPING, AS_OF_MS))


@register(
    "jsonl_overlong",
    """
SELECT doc_id, strlen(text) + 1 > 600 AS over, CASE WHEN strlen(text) + 1 > 600 THEN 'OVERSIZE' ELSE 'PARSE_ERROR' END
       AS error_code, CASE WHEN strlen(text) + 1 > 600 THEN 'cut' ELSE sha256(text) END AS raw_hash
FROM (SELECT doc_id, doc_id || ' ' || replace(replace(text, chr(10), ' '), chr(13), ' ') AS text FROM documents)
""",
)
def jsonl_overlong(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as lines: none is JSON, those over the (low) cap keep a marked preview."""
    flat = F.translate("text", "\n\r", "  ")
    path = write_lines(table(spark, sf_dir, "documents").select(text(F.col("doc_id"), " ", flat).alias("t")), "lines")
    points = json_points(read_jsonl(spark, path, max_line_bytes=600), _JSON_MAPPING, AS_OF_MS)
    over = F.col("error_code") == "OVERSIZE"
    cut = over & F.col("raw").endswith(" (truncated)")
    return points.select(
        F.regexp_extract("raw", r"\A(\d+) ", 1).cast("bigint").alias("doc_id"),
        over.alias("over"),
        "error_code",
        F.when(cut, F.lit("cut")).otherwise(F.sha2("raw", 256)).alias("raw_hash"),
    )


@register(
    "json_wrapped_scan",
    f"""
SELECT event_id, {_JSON_GOOD} AS good, CASE WHEN {_JSON_GOOD} THEN {_JSON_NS} ELSE -1 END AS timestamp_ns,
       CASE WHEN {_JSON_GOOD} THEN value END AS metric_0,
       CASE WHEN NOT ({_JSON_GOOD}) THEN 'PARSE_ERROR' END AS error_code
FROM events
""",
)
def json_wrapped_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per 500 events; the wrapper key changes with the document, others are roots of arrays."""
    records = _event_json(spark, sf_dir, broken=False)
    listed = records.groupBy(F.call_function("div", F.col("event_id"), F.lit(500)).alias("doc")).agg(
        F.array_join(F.collect_list("raw"), ",\n").alias("items")
    )
    body = pick(
        F.col("doc"),
        text('{"rows":[', F.col("items"), "]}"),
        text(' {"meta":{"rows":1},"data":[', F.col("items"), "]}"),
        text('{"records":[', F.col("items"), '],"total":1}'),
        text("\n[", F.col("items"), "]"),
    )
    path = scratch_path(spark, "json")
    listed.select(body.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    points = json_points(read_json(spark, path), _JSON_MAPPING, AS_OF_MS)
    return _with_id(points).select(
        "event_id",
        F.col("error_code").isNull().alias("good"),
        "timestamp_ns",
        "metric_0",
        "error_code",
    )


_LINES = PointMapping({"l_quantity": 0, "l_extendedprice": 1}, 2, TimeSpec(field="l_shipdate"))


@register(
    "parquet_mapped",
    """
SELECT epoch_us(l_shipdate) * 1000 AS timestamp_ns, l_quantity AS metric_0, l_extendedprice AS metric_1,
       CAST(NULL AS VARCHAR) AS error_code, 'row_' || file_row_number AS raw
FROM (SELECT *, row_number() OVER () - 1 AS file_row_number FROM lineitem)
""",
)
def parquet_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem")
    return shown(parquet_points(read_parquet(spark, f"{sf_dir}/lineitem.parquet"), _LINES, AS_OF_MS))


@register(
    "output_headers",
    "SELECT epoch_us(l_shipdate) * 1000 AS timestamp_ns, l_quantity AS qty, l_extendedprice AS amount FROM lineitem",
)
def output_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem")
    points = parquet_points(read_parquet(spark, f"{sf_dir}/lineitem.parquet"), _LINES, AS_OF_MS)
    return output_columns(points, OutputOptions(headers=("qty", "amount")).header_names(2))


@register(
    "parquet_passthrough",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') AS l_shipdate
FROM lineitem
""",
)
def parquet_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines are parsed again for the comparison."""
    rows = table(spark, sf_dir, "lineitem")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema} | {"l_shipdate": "string"}
    lines = passthrough_lines(read_parquet(spark, f"{sf_dir}/lineitem.parquet"))
    return lines.select(F.from_json("line", ", ".join(f"{n} {k}" for n, k in kinds.items())).alias("r")).select("r.*")


@register(
    "parquet_wild_times",
    f"""
SELECT event_id, CASE WHEN event_id % 5 < 3 THEN -1 ELSE epoch_us(ts) * 1000 END AS timestamp_ns,
       CASE WHEN event_id % 5 >= 3 THEN value END AS metric_0, CASE WHEN event_id % 5 >= 3 THEN {_K} END AS metric_1,
       CASE WHEN event_id % 5 < 3 THEN 'PARSE_ERROR' END AS error_code
FROM events
""",
)
def parquet_wild_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in 9999 and 1900 and missing ones reject their record and leave the others alone."""
    path = scratch_path(spark, "wild")
    kind = F.pmod("event_id", F.lit(5))
    moment = (
        F.when(kind == 0, F.lit("9999-12-31 00:00:00").cast("timestamp"))
        .when(kind == 1, F.lit("1900-01-01 00:00:00").cast("timestamp"))
        .when(kind != 2, F.col("ts").cast("timestamp"))
    )
    table(spark, sf_dir, "events").select(
        "event_id", moment.alias("ts_ms"), F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    ).write.parquet(path)
    rows = read_parquet(spark, path).withColumn("raw", F.lit(""))
    return shown(normalize_columns(rows, MAPPING, F.lit(""), AS_OF_MS), "event_id").drop("raw")


def _tree(spark: SparkSession, sf_dir: str) -> str:
    """Events spread over CSV, TSV, JSON and Parquet files of one folder tree, by event_id."""
    root = scratch_path(spark, "tree")
    events = table(spark, sf_dir, "events")
    fields = events.select(
        "event_id",
        ms("ts").alias("ts_ms"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    )
    part = lambda i: fields.filter(F.pmod("event_id", F.lit(4)) == i)
    for i, (name, sep) in enumerate((("csv", ","), ("tsv", "\t"))):
        part(i).write.option("header", True).option("sep", sep).option("extension", name).csv(f"{root}/{name}")
    grouped = part(2).groupBy(F.call_function("div", F.col("event_id"), F.lit(1000)).alias("g"))
    wrapped = grouped.agg(F.collect_list(F.struct("event_id", "ts_ms", "price", "volume")).alias("rows"))
    wrapped.select("rows").write.option("maxRecordsPerFile", 1).json(f"{root}/deep/json")
    for i, kind in enumerate(("bigint", "double")):
        typed = part(3).filter(F.pmod("event_id", F.lit(8)) == 3 + 4 * i).withColumn("volume", F.col("volume").cast(kind))
        typed.write.parquet(f"{root}/deep/parquet/{kind}")
    return root


_TREE_SQL = f"""
SELECT {_NS} AS timestamp_ns, value AS metric_0, {_K} AS metric_1,
       CASE event_id % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'tsv' WHEN 2 THEN 'json' ELSE 'parquet' END AS format,
       CAST(NULL AS VARCHAR) AS error_code
FROM events
"""
_TREE_FORMATS = ("csv", "tsv", "json", "parquet")


@register("directory_union", _TREE_SQL)
def directory_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = directory_points(spark, _tree(spark, sf_dir), MAPPING, _TREE_FORMATS, as_of_ms=AS_OF_MS)
    return shown(points, "format").drop("raw")


@register(
    "counts_per_file",
    """
SELECT CASE event_id % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'tsv' WHEN 2 THEN 'json' ELSE 'parquet' END AS format,
       count(*) FILTER (value <= 400.0) AS accepted, count(*) FILTER (value > 400.0) AS dropped, true AS many
FROM events GROUP BY 1
""",
)
def file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per file, then summed per kind of file, since file names are random."""
    points = directory_points(spark, _tree(spark, sf_dir), MAPPING, _TREE_FORMATS, as_of_ms=AS_OF_MS)
    judged = apply_checks(points, _STRICT, AS_OF_MS, 2)
    per_file = counts_per_file(judged).withColumn("format", F.regexp_extract("file_path", r"\.([a-z]+)\z", 1))
    return per_file.groupBy("format").agg(
        F.sum("accepted").alias("accepted"), F.sum("dropped").alias("dropped"), (F.count("*") >= 1).alias("many")
    )


@register(
    "resume_by_cursor",
    f"""
SELECT epoch_us(ts) * 1000 AS timestamp_ns, value AS metric_0, {_K} AS metric_1,
       CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS run
FROM events
""",
)
def resume_by_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run sees one folder; the second, started from the saved cursor, reads only what came later."""
    root, state = scratch_path(spark, "resume"), scratch_path(spark, "state")
    events = table(spark, sf_dir, "events")
    fields = events.select(
        native_to_ns(F.col("ts")).alias("ts_ns"),
        "event_id",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )
    mapping = PointMapping({"price": 0, "volume": 1}, 2, TimeSpec(field="ts_ms", unit="ms"))
    look = {"recursiveFileLookup": True}

    def run(number: int) -> DataFrame:
        rows = read_parquet(spark, root, cursor=resume.load_cursor(spark, state), **look)
        points = parquet_points(rows.withColumn("ts_ms", F.timestamp_micros(F.call_function("div", "ts_ns", F.lit(1000)))), mapping, AS_OF_MS)
        return points.withColumn("run", F.lit(number))

    first = F.pmod("event_id", F.lit(3)) == 0
    fields.filter(first).write.parquet(f"{root}/day=1")
    out = scratch_path(spark, "resumed")
    run(1).write.parquet(f"{out}/run=a")
    resume.save_cursor(spark, state, resume.last_file(run(1)).first().last_path)
    fields.filter(~first).write.parquet(f"{root}/day=2")
    run(2).write.parquet(f"{out}/run=b")
    both = spark.read.parquet(f"{out}/run=a", f"{out}/run=b")
    return both.select("timestamp_ns", *metric_columns(["metric_0", "metric_1"]), "run")


_RUN_GATE = GateOptions(future_tolerance_ms=10**15, stale_tolerance_ms=10**15, bounds={0: Bound(max=400.0)})


def _read_run(spark: SparkSession, out: str) -> DataFrame:
    """Both outputs of folder runs, with the number of their run."""
    good = spark.read.parquet(f"{out}/accepted").select(
        "run", F.lit("accepted").alias("output"), "timestamp_ns", F.col("price").alias("metric_0"),
        F.col("volume").alias("metric_1"), F.lit(None).cast("string").alias("reason_code"),
    )
    bad = spark.read.parquet(f"{out}/dead").select(
        "run", F.lit("dead letter").alias("output"),
        F.when(F.col("reason_code") != "FILE_READ_ERROR", F.col("timestamp_ns")).alias("timestamp_ns"),
        F.col("observed").alias("metric_0"), F.lit(None).cast("double").alias("metric_1"), "reason_code",
    )
    return good.unionByName(bad)


@register(
    "directory_with_bad_files",
    f"""
SELECT 1 AS run, CASE WHEN value <= 400.0 THEN 'accepted' ELSE 'dead letter' END AS output, {_NS} AS timestamp_ns,
       value AS metric_0, CASE WHEN value <= 400.0 THEN {_K} END AS metric_1,
       CASE WHEN value > 400.0 THEN 'ABOVE_MAX' END AS reason_code, 0 AS failed_files
FROM events
UNION ALL
SELECT 1, 'dead letter', NULL, NULL, NULL, 'FILE_READ_ERROR', 4 FROM nation WHERE n_nationkey < 4
""",
)
def directory_with_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in files of four formats, and among them files that cannot be read or cannot be points.

    The Parquet files have different types.  The bad ones: text under a Parquet name, packed text that ends early,
    Parquet with a text for a number, and Parquet without a column.
    """
    root, out = _tree(spark, sf_dir), scratch_path(spark, "folder-out")
    nations = table(spark, sf_dir, "nation").coalesce(1)
    nations.select("n_name").write.text(f"{root}/odd/text")
    named = nations.select(F.col("n_nationkey").alias("ts_ms"), F.col("n_name").alias("price"), F.lit(1).alias("volume"))
    named.write.parquet(f"{root}/odd/named")
    named.drop("price").write.parquet(f"{root}/odd/without")
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{root}/odd/text")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        if status.getPath().getName().startswith("part-"):
            files.rename(status.getPath(), hadoop.Path(f"{root}/odd/nations.parquet"))
    cut = files.create(hadoop.Path(f"{root}/odd/cut.csv.gz"))
    cut.write(bytearray(gzip.compress(HEADER.encode())[:16]))
    cut.close()
    done = run_folder(
        spark, root, MAPPING, _RUN_GATE, OutputOptions(), out, scratch_path(spark, "state"),
        as_of_ms=AS_OF_MS, dead_letter_text=False,
    )
    failed = F.when(F.col("reason_code") == "FILE_READ_ERROR", F.lit(done["failed"])).otherwise(F.lit(0))
    return _read_run(spark, out).withColumn("failed_files", failed)


@register(
    "folder_run_resume",
    f"""
SELECT CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS run,
       CASE WHEN value <= 400.0 THEN 'accepted' ELSE 'dead letter' END AS output, {_NS} AS timestamp_ns,
       value AS metric_0, CASE WHEN value <= 400.0 THEN {_K} END AS metric_1,
       CASE WHEN value > 400.0 THEN 'ABOVE_MAX' END AS reason_code, true AS counted
FROM events
""",
)
def folder_run_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a folder that grows in between; the second reads only what came after the first one's cursor."""
    root, out, state = (scratch_path(spark, label) for label in ("grows", "folder-out", "state"))
    fields = table(spark, sf_dir, "events").select(
        "event_id",
        ms("ts").alias("ts_ms"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )
    first = F.pmod("event_id", F.lit(3)) == 0
    counted = F.lit(0)
    for day, part in ((1, fields.filter(first)), (2, fields.filter(~first))):
        part.write.option("header", True).csv(f"{root}/day={day}")
        done = run_folder(
            spark, root, MAPPING, _RUN_GATE, OutputOptions(), out, state,
            as_of_ms=AS_OF_MS, complete=day == 2, dead_letter_text=False,
        )
        counted = F.when(F.col("run") == day, F.lit(done["accepted"] + done["dropped"])).otherwise(counted)
    rows = _read_run(spark, out)
    sizes = rows.groupBy("run").agg((F.count("*") == F.first(counted)).alias("counted"))
    return rows.join(F.broadcast(sizes), "run")  # one row per run
