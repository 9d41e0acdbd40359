"""Queries of the message decoders: messages are rendered from orders, lineitem and events, one per row."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.functions.times import native_to_ns
from pointgate.operators.changes import decode_change_rows, last_position
from pointgate.operators.feeds import decode_feed
from pointgate.operators.normalize import normalize_custom_feed, normalize_json_paths, normalize_typed_points
from pointgate.operators.points import metric_columns
from pointgate.operators.syslog import decode_syslog
from pointgate.options import PathMapping
from pointgate.plans.fixtures import AS_OF_MS, ms, pick, table, text
from pointgate.plans.registry import register
from pointgate.session import scratch_path
from pointgate.sources.messages import decode_csv_bodies, decode_datagrams, decode_kafka, decode_pages, read_landed
from pointgate.sources.wire import wire_points
from pointgate.streaming.run import run_for

AS_OF_NS = AS_OF_MS * 1_000_000


def shown(df: DataFrame, *keys: str, metrics: int = 2, raw: bool = False) -> DataFrame:
    """Points with plain columns; a rejected record has time -1."""
    return df.select(
        *keys,
        F.coalesce("timestamp_ns", F.lit(-1)).alias("timestamp_ns"),
        "feed",
        *metric_columns([f"metric_{i}" for i in range(metrics)]),
        "error_code",
        *(["raw"] if raw else []),
    )


def expected(source: str, keys: str, kind: str, cases: list[str], metrics: int) -> str:
    """SQL of the expected points: cases[kind] is 'ts, feed, m0, m1, ...', '' (dropped) or 'bad' (rejected)."""
    slots = ["timestamp_ns", "feed", *(f"metric_{i}" for i in range(metrics))]
    kinds = ["BIGINT", "VARCHAR", *["DOUBLE"] * metrics]
    dropped = [str(i) for i, c in enumerate(cases) if not c]
    parts = []
    for i, (slot, sql_type) in enumerate(zip(slots, kinds)):
        whens = []
        for k, case in enumerate(cases):
            if not case:
                continue
            values = [v.strip() for v in case.split(";")] if case != "bad" else ["-1"]
            whens.append(f"WHEN {k} THEN CAST({values[i] if i < len(values) else 'NULL'} AS {sql_type})")
        parts.append(f"CASE {kind} {' '.join(whens)} END AS {slot}")
    bad = [str(i) for i, c in enumerate(cases) if c == "bad"]
    error = f"CASE WHEN {kind} IN ({', '.join(bad)}) THEN 'PARSE_ERROR' END" if bad else "CAST(NULL AS VARCHAR)"
    where = f"WHERE {kind} NOT IN ({', '.join(dropped)})" if dropped else ""
    return f"SELECT {keys}, {', '.join(parts)}, {error} AS error_code FROM {source} {where}"


# orders: price o_totalprice, quantity o_custkey + 1
_P, _Q = "o_totalprice", "(o_custkey + 1)"


def _order_messages(spark: SparkSession, sf_dir: str, *messages: Column) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", pick(F.col("o_orderkey"), *messages).alias("raw")
    )


def _price() -> Column:
    return F.col("o_totalprice")


def _quantity() -> Column:
    return F.col("o_custkey") + 1


@register(
    "feed_kraken",
    expected(
        "orders",
        "o_orderkey",
        "o_orderkey % 10",
        [
            f"{AS_OF_NS}; 'trade'; {_P}; {_Q}",
            f"{AS_OF_NS}; 'trade'; {_P}; {_Q}",
            f"{AS_OF_NS}; 'ticker'; {_P}; {_P} + 1; {_P} + 2; {_Q}",
            "",
            f"{AS_OF_NS}; 'book'; {_P}; {_Q}; {_P} + 1; {_Q} + 1",
            f"{AS_OF_NS}; 'ohlc'; {_P}; {_P} + 3; {_P} - 3; {_P} + 1; 0.0",
            "",
            "bad",
            "",
            "",
        ],
        5,
    ),
)
def feed_kraken(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, q = _price(), _quantity()
    messages = _order_messages(
        spark,
        sf_dir,
        text('{"channel":"trade","type":"update","data":[{"symbol":"A/B","price":', p, ',"qty":', q, "}]}"),
        text('{"channel":"trade","data":[{"price":"', p, '","quantity":"', q, '"},{"price":1,"qty":1}]}'),
        text(
            '{"channel":"ticker","data":[{"bid":', p, ',"ask":', p + 1, ',"last":', p + 2, ',"volume":', q, "}]}"
        ),
        text('{"channel":"ticker","data":[{"bid":', p, ',"ask":', p + 1, ',"last":', p + 2, "}]}"),
        text(
            '{"channel":"book","data":[{"bids":[{"price":', p, ',"qty":', q, '}],"asks":[{"price":', p + 1,
            ',"qty":', q + 1, "}]}]}",
        ),
        text(
            '{"channel":"ohlc","data":[{"open":', p, ',"high":', p + 3, ',"low":', p - 3, ',"close":', p + 1,
            ',"volume":"n/a"}]}',
        ),
        text('{"method":"subscribe","channel":"trade","data":[{"price":', p, ',"qty":', q, "}]}"),
        text('{"channel":"trade","data":[{"price":', p),
        text('{"channel":"trade","data":[{"price":0,"qty":', q, "}]}"),
        text('{"channel":"status","data":[{"price":', p, ',"qty":', q, "}]}"),
    )
    return shown(decode_feed(messages, "kraken", as_of_ms=AS_OF_MS), "o_orderkey", metrics=5)


@register(
    "feed_kraken_all",
    f"""
SELECT o_orderkey, {AS_OF_NS} AS timestamp_ns, 'trade' AS feed, {_P} + n AS metric_0, CAST({_Q} AS DOUBLE) AS metric_1,
       CAST(NULL AS VARCHAR) AS error_code
FROM orders, range(3) AS r(n) WHERE n < o_orderkey % 4
""",
)
def feed_kraken_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of up to three trades, a point of each; messages without a trade give none."""
    row = lambda n: text('{"price":', _price() + n, ',"qty":', _quantity(), "}")
    rows = [F.slice(F.array(row(0), row(1), row(2)), 1, n) for n in range(4)]
    lists = [text('{"channel":"trade","data":[', F.array_join(part, ","), "]}") for part in rows]
    messages = _order_messages(spark, sf_dir, *lists)
    return shown(decode_feed(messages, "kraken", as_of_ms=AS_OF_MS, explode_all=True), "o_orderkey")


_L_TS = "epoch_us(l_shipdate) * 1000"
_LP, _LQ = "l_extendedprice", "l_quantity"


@register(
    "feed_binance",
    expected(
        "lineitem",
        "l_orderkey, l_linenumber",
        "(l_orderkey + l_linenumber) % 11",
        [
            f"{_L_TS}; 'trade'; {_LP}; {_LQ}",
            f"{AS_OF_NS}; 'trade'; {_LP}; {_LQ}",
            f"{_L_TS}; 'trade'; {_LP}; {_LQ}",
            f"{_L_TS}; 'ticker'; {_LP}; {_LP} + 1; {_LP} + 2; 0.0",
            f"{_L_TS}; 'depth'; {_LP}; {_LQ}; {_LP} + 1; {_LQ} + 1",
            f"{_L_TS}; 'kline'; {_LP}; {_LP} + 3; {_LP} - 3; {_LP} + 1; {_LQ}",
            f"{AS_OF_NS}; 'markPrice'; {_LP}; 0.0",
            "",
            "bad",
            "",
            "",
        ],
        5,
    ),
)
def feed_binance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, q, moment = F.col("l_extendedprice"), F.col("l_quantity"), ms("l_shipdate")
    messages = pick(
        F.col("l_orderkey") + F.col("l_linenumber"),
        text('{"e":"trade","E":', moment, ',"p":"', p, '","q":"', q, '"}'),
        # A time that is text is not used.
        text('{"e":"aggTrade","E":"', moment, '","p":', p, ',"q":', q, "}"),
        text('{"stream":"x@trade","data":{"e":"trade","E":', moment, ',"p":"', p, '","q":"', q, '"}}'),
        text('{"e":"24hrTicker","E":', moment, ',"b":"', p, '","a":"', p + 1, '","c":"', p + 2, '"}'),
        text(
            '{"e":"depthUpdate","E":', moment, ',"b":[["', p, '","', q, '"],["1","1"]],"a":[["', p + 1, '","',
            q + 1, '"]]}',
        ),
        text(
            '{"e":"kline","E":1,"k":{"T":', moment, ',"o":"', p, '","h":"', p + 3, '","l":"', p - 3, '","c":"',
            p + 1, '","v":"', q, '"}}',
        ),
        text('{"e":"markPriceUpdate","p":"', p, '"}'),
        text('{"result":null,"id":', F.col("l_orderkey"), "}"),
        text('{"e":"trade","E":', moment, ',"p":"', p, '"} {}'),
        text('{"e":"trade","p":"', p, '","q":"0"}'),
        text('{"stream":"x@trade","e":"trade","p":"', p, '","q":"', q, '"}'),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", messages.alias("raw")
    )
    return shown(decode_feed(lines, "binance", as_of_ms=AS_OF_MS), "l_orderkey", "l_linenumber", metrics=5)


_O_TS = "epoch_us(o_orderdate) * 1000"
_RPC_SHARED = [
    f"{_O_TS}; 'user_data'; {_P}; {_Q}",
    f"{_O_TS}; 'user_data'; {_P}; {_Q}",
    f"{AS_OF_NS}; 'user_data'; {_P}; {_Q}",
    "",
]


def _rpc_sql() -> str:
    parts = []
    for channel, cases in {
        "ticker_price": ["", f"{AS_OF_NS}; 'ticker_price'; {_P}", "", ""],
        "trades_recent": [f"{_O_TS}; 'trades_recent'; {_P}; {_Q}", "", "", ""],
        "depth_snapshot": ["", "", f"{AS_OF_NS}; 'depth_snapshot'; {_P}; {_Q}; {_P} + 1; {_Q} + 1", ""],
    }.items():
        keys = f"o_orderkey, '{channel}' AS channel"
        parts.append(expected("orders", keys, "o_orderkey % 9", [*_RPC_SHARED, *cases, "bad"], 4))
    return " UNION ALL ".join(parts)


@register("feed_rpc", _rpc_sql())
def feed_rpc(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, q, moment = _price(), _quantity(), ms("o_orderdate")
    report = ',"p":"', p, '","q":"', q, '"}}'
    messages = _order_messages(
        spark,
        sf_dir,
        text('{"event":{"e":"executionReport","E":', moment, ',"T":1', *report),
        text('{"event":{"e":"executionReport","T":', moment, *report),
        text('{"event":{"e":"executionReport","E":"later","T":', moment, *report),
        text('{"event":{"e":"balanceUpdate","E":', moment, *report),
        text('{"id":1,"status":200,"result":[{"price":"', p, '","qty":"', q, '","time":', moment, "}]}"),
        text('{"id":1,"status":200,"result":{"symbol":"X","price":"', p, '"}}'),
        text(
            '{"id":1,"status":200,"result":{"bids":[["', p, '","', q, '"]],"asks":[["', p + 1, '","', q + 1, '"]]}}'
        ),
        text('{"id":1,"status":400,"result":{"price":"', p, '"}}'),
        text('{"id":1,"status":200,"result":', p, ","),
    )
    parts = []
    for channel in ("ticker_price", "trades_recent", "depth_snapshot"):
        points = decode_feed(messages, "binance_ws_api", channels=["user_data", channel], as_of_ms=AS_OF_MS)
        parts.append(shown(points.withColumn("channel", F.lit(channel)), "o_orderkey", "channel", metrics=4))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_GAS = "(o_custkey + 21000)"
_FEE = "(o_orderkey + 1000000000)"


@register(
    "feed_eth",
    expected(
        "orders",
        "o_orderkey",
        "o_orderkey % 11",
        [
            f"{_O_TS}; 'newHeads'; {_FEE}; {_GAS}",
            f"{_O_TS}; 'newHeads'; {_GAS}; {_GAS}",
            f"{_O_TS}; 'newHeads'; {_GAS}; {_GAS}",
            f"{AS_OF_NS}; 'pending'; {_FEE}; {_GAS}",
            f"{AS_OF_NS}; 'pending'; {_FEE}; {_GAS}",
            f"{AS_OF_NS}; 'pending'; {_FEE}; 21000.0",
            "",
            "",
            f"{_O_TS}; 'newHeads'; {_FEE}; {_GAS}",
            "bad",
            "",
        ],
        2,
    ),
)
def feed_eth(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = lambda c: text("0x", F.lower(F.hex(c.cast("bigint"))))
    gas, fee = F.col("o_custkey") + 21_000, F.col("o_orderkey") + 1_000_000_000
    seconds = F.call_function("div", ms("o_orderdate"), F.lit(1000))
    head = '{"jsonrpc":"2.0","method":"eth_subscription","params":{"subscription":"0x1","result":{'
    block = head + '"number":"0x10","timestamp":"', digits(seconds), '","gasUsed":"', digits(gas), '"'
    messages = _order_messages(
        spark,
        sf_dir,
        text(*block, ',"baseFeePerGas":"', digits(fee), '"}}}'),
        text(*block, "}}}"),
        text(*block, ',"baseFeePerGas":"0x0"}}}'),
        text(head + '"hash":"0xaa","gasPrice":"', digits(fee), '","gas":"', digits(gas), '"}}}'),
        text(head + '"hash":"0xaa","gasPrice":"0x0","maxFeePerGas":"', digits(fee), '","gas":"', digits(gas), '"}}}'),
        text(head + '"hash":"0xaa","maxPriorityFeePerGas":"', digits(fee), '"}}}'),
        text('{"jsonrpc":"2.0","id":1,"result":"', digits(fee), '"}'),
        text(head + '"hash":"', digits(fee), '"}}}'),
        text(
            head + '"number":16,"timestamp":', seconds, ',"gasUsed":', gas, ',"baseFeePerGas":', fee, "}}}"
        ),
        text(head),
        text(head.replace("eth_subscription", "other") + '"hash":"0xaa","gasPrice":"', digits(fee), '"}}}'),
    )
    points = decode_feed(messages, "alchemy", channels=["newHeads", "pending"], as_of_ms=AS_OF_MS)
    return shown(points, "o_orderkey")


_E_NS = "epoch_us(ts) // 1000 * 1000000"
_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"


def _event_messages(spark: SparkSession, sf_dir: str, *messages: Column) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", "ts", pick(F.col("event_id"), *messages).alias("raw"))


@register(
    "normalize_custom_feed",
    expected(
        "events",
        "event_id",
        "event_id % 7",
        [
            f"{_E_NS}; NULL; value; {_K}",
            f"{_E_NS}; NULL; value; {_K}",
            "",
            "",
            "bad",
            "",
            f"0; NULL; value; {_K}",
        ],
        2,
    ),
)
def custom_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, props, moment = F.col("value"), F.col("props"), ms("ts")
    messages = _event_messages(
        spark,
        sf_dir,
        text('{"d":{"v":', v, '},"s":[', props, '],"t":', moment, ".75}"),
        text('{"d":{"v":"', v, '"},"s":[', props, '],"t":"', moment, '"}'),
        text('{"d":{},"s":[', props, '],"t":', moment, "}"),
        text('{"d":{"v":true},"s":[', props, '],"t":', moment, "}"),
        text('{"d":{"v":', v, '},"s":[', props, '],"t":'),
        # A numeric part is only a list position here, never a key.
        text('{"d":{"v":', v, '},"s":{"0":', props, '},"t":', moment, "}"),
        text('{"d":{"v":', v, '},"s":[', props, '],"t":-5}'),
    )
    return shown(
        normalize_custom_feed(messages, "raw", PathMapping(("d.v", "s.0.k"), "t"), AS_OF_MS), "event_id"
    )


_PATH_CASES = [
    f"{_E_NS}; NULL; value; {_K}",
    f"epoch_us(ts) * 1000; NULL; value; {_K}",
    f"{AS_OF_NS}; NULL; value; {_K}",
    "bad",
    "bad",
    "bad",
    "bad",
    f"0; NULL; value; {_K}",
    "bad",
]


def _path_messages(v: Column, props: Column, moment: Column, words: Column) -> list[Column]:
    return [
        text('{"d":{"v":', v, '},"s":{"0":', props, '},"t":', moment, ".75}"),
        text('{"d":{"v":"', v, '"},"s":[', props, '],"t":"', words, '"}'),
        text('{"d":{"v":', v, '},"s":[', props, '],"t":null}'),
        text('{"d":{"v":', v, '},"s":[', props, "]}"),
        text('{"d":{"v":false},"s":[', props, '],"t":', moment, "}"),
        text('{"d":{"v":"inf"},"s":[', props, '],"t":', moment, "}"),
        text('{"d":{"v":', v, '},"s":[', props, '],"t":"yesterday"}'),
        text('{"d":{"v":', v, '},"s":[', props, '],"t":-5}'),
        text('{"d":{"v":', v, '},"s":[', props, '],"t":', moment, "}}"),
    ]


_PATHS = PathMapping(("d.v", "s.0.k"), "t")


@register("normalize_json_paths", expected("events", "event_id", "event_id % 9", _PATH_CASES, 2))
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    messages = _event_messages(
        spark, sf_dir, *_path_messages(F.col("value"), F.col("props"), ms("ts"), words)
    )
    return shown(normalize_json_paths(messages, "raw", _PATHS, AS_OF_MS), "event_id")


@register(
    "kafka_decode",
    "SELECT event_id % 3 AS part, event_id AS off, * EXCLUDE (event_id) FROM ("
    + expected("events", "event_id", "event_id % 11", [*_PATH_CASES, "", "bad"], 2)
    + ")",
)
def kafka_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    words = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    good = [m.cast("binary") for m in _path_messages(F.col("value"), F.col("props"), ms("ts"), words)]
    value = pick(F.col("event_id"), *good, F.lit(None).cast("binary"), F.unhex(F.lit("7bff7d")))
    rows = events.select(
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
        F.lit("points").alias("topic"),
        F.pmod("event_id", F.lit(3)).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    points = decode_kafka(rows, _PATHS, AS_OF_MS).withColumnsRenamed({"partition": "part", "offset": "off"})
    return shown(points, "part", "off")


@register(
    "datagram_decode", expected("events", "event_id", "event_id % 10", [*_PATH_CASES, ""], 2)
)
def datagram_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    payloads = _path_messages(F.col("value"), F.col("props"), ms("ts"), words)
    messages = _event_messages(spark, sf_dir, *payloads, F.lit(""))
    return shown(decode_datagrams(messages, _PATHS, as_of_ms=AS_OF_MS), "event_id")


@register(
    "cdc_change_rows",
    expected(
        "orders",
        "o_orderkey",
        "o_orderkey % 10",
        [
            f"{_O_TS}; NULL; {_P}; {_Q}",
            f"{_O_TS}; NULL; {_P}; {_Q}",
            "",
            "",
            "bad",
            "",
            "bad",
            f"{_O_TS}; NULL; {_P}; {_Q}",
            f"{AS_OF_NS}; NULL; {_P}; {_Q}",
            "bad",
        ],
        2,
    ),
)
def cdc_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, q, moment = _price(), _quantity(), ms("o_orderdate")

    def change(action: str, ts: list[str | Column], *more: str | Column) -> Column:
        return text(
            '{"action":"' + action + '","schema":"s","table":"t","columns":[{"name":"price","type":"float8","value":',
            p, '},{"name":"qty","type":"text","value":"', q, '"},{"name":"at","type":"x","value":', *ts, "}]", *more,
            "}",
        )

    messages = _order_messages(
        spark,
        sf_dir,
        change("I", [moment]),
        change("U", ['"', F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), '"']),
        F.lit('{"action":"B"}'),
        text('{"action":"D","identity":[{"name":"id","value":', F.col("o_orderkey"), "}]}"),
        text('{"action":"I","columns":[{"name":"qty","value":', q, '},{"name":"at","value":', moment, "}]}"),
        F.lit("   "),
        text('{"action":"I","columns":['),
        # Not among the columns: looked up as paths of the message.
        text('{"action":"I","columns":[{"name":"price","value":', p, '}],"qty":', q, ',"at":', moment, "}"),
        change("D", ["false"]),
        text('{"action":"I","columns":[{"name":"price","value":true},{"name":"qty","value":', q, "}]}"),
    )
    return shown(
        decode_change_rows(messages, "raw", PathMapping(("price", "qty"), "at"), AS_OF_MS), "o_orderkey"
    )


_LSN = "upper(to_hex(o_orderkey + 4096)) || '/' || upper(to_hex(o_custkey + 1))"


@register(
    "cdc_last_lsn",
    f"""
SELECT o_orderstatus, coalesce(max_by({_LSN}, o_orderkey) FILTER (o_orderkey % 3 = 1), '0/0') AS last_position
FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'none' AS o_orderstatus, '0/0' AS last_position
""",
)
def cdc_last_lsn(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lsn = text(F.hex(F.col("o_orderkey") + 4096), "/", F.hex(F.col("o_custkey") + 1))
    rows = orders.withColumn("lsn", pick(F.col("o_orderkey"), F.lit(None), lsn, F.lit("  ")))
    last = last_position(rows, "lsn", ["o_orderkey"], by=["o_orderstatus"])
    blank = rows.withColumns({"lsn": F.lit(""), "o_orderstatus": F.lit("none")})
    return last.unionByName(last_position(blank, "lsn", ["o_orderkey"], by=["o_orderstatus"]))


@register(
    "syslog_5424",
    expected(
        "events",
        "event_id",
        "event_id % 7",
        [
            "epoch_us(ts) * 1000; NULL; 1.0; 1.0",
            "epoch_us(ts) * 1000 + 789 - 3600000000000; NULL; 1.0; 1.0",
            f"{AS_OF_NS}; NULL; 1.0; 1.0",
            f"{AS_OF_NS}; NULL; 1.0; 1.0",
            "",
            f"{AS_OF_NS}; NULL; 1.0; 1.0",
            "epoch_us(ts) // 1000000 * 1000000000; NULL; 1.0; 1.0",
        ],
        2,
    ),
)
def syslog_5424(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    tail = " host app - - message"
    messages = _event_messages(
        spark,
        sf_dir,
        text("<34>1 ", iso, "Z" + tail + "\r\n"),
        text("<34>1 ", iso, "789+01:00" + tail),
        F.lit("<34>1 -" + tail),
        text("34 1 ", iso, "Z" + tail),
        F.lit("\r\n"),
        text("<34>1 ", F.date_format("ts", "yyyy-13-dd'T'HH:mm:ss"), "Z" + tail),
        text("<34> 1  ", F.date_format("ts", "yyyy-MM-dd't'HH:mm:ss'z'"), tail),
    )
    return shown(decode_syslog(messages, "raw", "rfc5424", 2, as_of_ms=AS_OF_MS), "event_id")


@register(
    "syslog_3164",
    expected(
        "events",
        "event_id",
        "event_id % 5",
        [
            "epoch_us(ts) // 1000000 * 1000000000; NULL; 1.0; 1.0",
            "epoch_us(ts) // 1000000 * 1000000000; NULL; 1.0; 1.0",
            f"{AS_OF_NS}; NULL; 1.0; 1.0",
            f"{AS_OF_NS}; NULL; 1.0; 1.0",
            f"{AS_OF_NS}; NULL; 1.0; 1.0",
        ],
        2,
    ),
)
def syslog_3164(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = F.date_format("ts", "HH:mm:ss")
    tail = " host tag: message"
    messages = _event_messages(
        spark,
        sf_dir,
        text("<34>", F.date_format("ts", "MMM d "), clock, tail),
        text("<34>", F.date_format("ts", "MMM dd "), clock, tail),
        text("<34>jan 5 ", clock, tail),
        text("<34>Feb 30 ", clock, tail),
        text("<34>", F.date_format("ts", "MMM d "), clock, ".5", tail),
    )
    return shown(decode_syslog(messages, "raw", "rfc3164", 2, 2024, AS_OF_MS), "event_id")


def _wire(kind: int, ns: int, price: float, volume: float) -> bytes:
    """One message as bytes; kinds differ in form, the last two are damaged."""

    def varint(n: int) -> bytes:
        out = bytearray()
        while n >= 0x80:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        return bytes(out) + bytes([n])

    moment, doubles = b"\x08" + varint(ns), struct.pack("<2d", price, volume)
    return (
        moment + b"\x12\x10" + doubles,
        b"\x11" + doubles[:8] + moment + b"\x11" + doubles[8:],
        b"\x1a\x03abc" + b"\x12\x08" + doubles[:8] + b"\x12\x08" + doubles[8:] + b"\x25\x00\x00\x00\x00" + moment,
        moment,
        moment + b"\x12\x10" + doubles[:9],
        b"\x0d\x00\x00\x00\x00" + b"\x12\x10" + doubles,
    )[kind]


@register(
    "typed_points_wire",
    f"""
SELECT event_id, CASE WHEN event_id % 6 < 3 THEN epoch_us(ts) * 1000 ELSE -1 END AS timestamp_ns, CAST(NULL AS VARCHAR) AS feed,
       CASE WHEN event_id % 6 < 3 THEN value END AS metric_0, CASE WHEN event_id % 6 < 3 THEN {_K} END AS metric_1,
       CASE WHEN event_id % 6 >= 4 THEN 'PARSE_ERROR' END AS error_code
FROM events WHERE event_id % 6 <> 3
""",
)
def typed_points_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of typed points: packed, single, split with unknown fields, without metrics, cut off, of another type."""
    fields = table(spark, sf_dir, "events").select(
        "event_id", native_to_ns(F.col("ts")).alias("ns"), "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )

    def encode(batches):
        for batch in batches:
            ids, *rest = (c.to_pylist() for c in batch.columns)
            made = [_wire(i % 6, *row) for i, row in zip(ids, zip(*rest))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["event_id", "value"])

    messages = fields.mapInArrow(encode, "event_id long, value binary")
    return shown(wire_points(messages, "value", AS_OF_MS), "event_id")


@register(
    "typed_points",
    f"""
SELECT event_id, CASE event_id % 5 WHEN 1 THEN {AS_OF_NS} WHEN 2 THEN -1 ELSE epoch_us(ts) * 1000 END AS timestamp_ns,
       CAST(NULL AS VARCHAR) AS feed, CASE WHEN event_id % 5 <> 2 THEN value END AS metric_0,
       CASE WHEN event_id % 5 <> 2 AND event_id % 5 <> 4 THEN {_K} END AS metric_1,
       CASE WHEN event_id % 5 = 2 THEN 'BAD_TIMESTAMP' END AS error_code
FROM events WHERE event_id % 5 <> 3
""",
)
def typed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero time, negative time, no metrics, fewer metrics."""
    ns, value = native_to_ns(F.col("ts")), F.col("value")
    k = F.get_json_object("props", "$.k").cast("double")
    both, one = F.array(value, k), F.array(value)
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        pick(F.col("event_id"), ns, F.lit(0), -ns, ns, ns).alias("timestamp_ns"),
        pick(F.col("event_id"), both, both, both, F.array().cast("array<double>"), one).alias("metrics"),
    )
    return shown(normalize_typed_points(rows, as_of_ms=AS_OF_MS), "event_id")


_PAGE_SQL = f"""
items AS (
  SELECT event_id // 100 AS page_no, event_id % 100 AS item_no, epoch_us(ts) // 1000 * 1000000 AS ns, value,
         event_id % 10 = 3 AS bad, event_id
  FROM events)
"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """100 events per page: mostly arrays; the page size is that of the service, not a cut of the data."""
    events = table(spark, sf_dir, "events")
    item = F.when(
        F.pmod("event_id", F.lit(10)) == 3, text('{"t":', ms("ts"), "}")
    ).otherwise(text('{"v":', F.col("value"), ',"t":', ms("ts"), "}"))
    numbered = events.select(F.call_function("div", F.col("event_id"), F.lit(100)).alias("page_no"), "event_id", item.alias("item"))
    listed = numbered.groupBy("page_no").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("items")
    )
    return listed.select("page_no", F.transform("items", lambda i: i["item"]).alias("items"))


@register(
    "rest_pages_decode",
    f"""
WITH {_PAGE_SQL}, last AS (SELECT max(page_no) AS page FROM items)
SELECT page_no, CAST(item_no AS INTEGER) AS item_no, CASE WHEN bad THEN -1 ELSE ns END AS timestamp_ns,
       CAST(NULL AS VARCHAR) AS feed, CASE WHEN NOT bad THEN value END AS metric_0,
       CASE WHEN bad THEN 'PARSE_ERROR' END AS error_code
FROM items, last WHERE page_no < greatest(page // 2, 1)
""",
)
def rest_pages_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page in the middle has no good record, so visiting ends before it."""
    pages = _pages(spark, sf_dir)
    middle = pages.agg(F.greatest(F.call_function("div", F.max("page_no"), F.lit(2)), F.lit(1)).alias("m")).scalar()
    listed = text("[", F.array_join("items", ","), "]")
    pages = pages.select("page_no", F.when(F.col("page_no") == middle, F.lit('[{"v":null}]')).otherwise(listed).alias("body"))
    return shown(decode_pages(pages, PathMapping(("v",), "t"), as_of_ms=AS_OF_MS), "page_no", "item_no", metrics=1)


@register(
    "rest_pages_cursor",
    f"""
WITH {_PAGE_SQL}
SELECT event_id AS page_no, 0 AS item_no, ns AS timestamp_ns, CAST(NULL AS VARCHAR) AS feed, value AS metric_0,
       CAST(NULL AS VARCHAR) AS error_code
FROM items WHERE event_id < (SELECT max(event_id) FROM items)
""",
)
def rest_pages_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object pages of one record each; a cursor that is a number ends the visit before the last page."""
    events = table(spark, sf_dir, "events")
    ends = F.col("event_id") >= events.agg(F.max("event_id") - 1).scalar()
    cursor = F.when(ends, F.lit("5")).otherwise(F.lit('"next"'))
    item = text('{"v":', F.col("value"), ',"t":', ms("ts"), "}")
    body = text('{"o":[', item, '],"meta":{"next":', cursor, "}}")
    pages = events.select(F.col("event_id").alias("page_no"), body.alias("body"))
    mapping = PathMapping(("o.0.v",), "o.0.t")
    return shown(
        decode_pages(pages, mapping, cursor_path="meta.next", as_of_ms=AS_OF_MS), "page_no", "item_no", metrics=1
    )


@register(
    "limit_max_pages",
    f"""
WITH {_PAGE_SQL}
SELECT page_no, CAST(item_no AS INTEGER) AS item_no, CASE WHEN bad THEN -1 ELSE ns END AS timestamp_ns,
       CAST(NULL AS VARCHAR) AS feed, CASE WHEN NOT bad THEN value END AS metric_0,
       CASE WHEN bad THEN 'PARSE_ERROR' END AS error_code
FROM items WHERE page_no < 20
""",
)
def limit_max_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the feature: the run ends after 20 pages."""
    pages = _pages(spark, sf_dir).select("page_no", text("[", F.array_join("items", ","), "]").alias("body"))
    points = decode_pages(pages, PathMapping(("v",), "t"), max_pages=20, as_of_ms=AS_OF_MS)
    return shown(points, "page_no", "item_no", metrics=1)


@register(
    "rest_csv_body",
    expected(
        "orders",
        "o_orderkey",
        "o_orderkey % 7",
        [
            f"{AS_OF_NS}; NULL; {_P}; {_Q}",
            f"{AS_OF_NS}; NULL; {_P}; {_Q}",
            "bad",
            "bad",
            "bad",
            f"{AS_OF_NS}; NULL; {_P}; {_Q}",
            "bad",
        ],
        2,
    ),
)
def rest_csv_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, q = _price(), _quantity()
    messages = _order_messages(
        spark,
        sf_dir,
        text("price,qty,note\r\n", p, ",", q, ",x\r\n1,1,y\r\n"),
        text('note,"price",qty\n"a, ""b""\nc","', p, '",', q),
        text("cost,qty\n", p, ",", q),
        F.lit("price,qty\n"),
        text("price,qty\n", p, ",", q, ",extra"),
        text("\n\nqty,price\n\n", q, ",", p, "\n"),
        text("price,qty\nabc,", q),
    )
    return shown(decode_csv_bodies(messages, ["price", "qty"], "raw", AS_OF_MS), "o_orderkey")


_LANDED_SIZE = (
    """(strlen('{"channel":"trade","data":[{"price":,"qty":,"note":""}]}')"""
    " + strlen(CAST(n_chars + 1 AS VARCHAR)) + strlen(CAST(doc_id + 1 AS VARCHAR)) + 2 * strlen(text))"
)


@register(
    "raw_stream_oversize",
    f"""
WITH sized AS (SELECT *, {_LANDED_SIZE} > 4096 AS big FROM documents)
SELECT doc_id, CASE WHEN big THEN -1 ELSE {AS_OF_NS} END AS timestamp_ns, CASE WHEN NOT big THEN 'trade' END AS feed,
       CASE WHEN NOT big THEN CAST(n_chars + 1 AS DOUBLE) END AS metric_0,
       CASE WHEN NOT big THEN CAST(doc_id + 1 AS DOUBLE) END AS metric_1,
       CASE WHEN big THEN 'OVERSIZE' END AS error_code,
       CASE WHEN big THEN '[oversize websocket text frame]' ELSE 'small' END AS raw
FROM sized
""",
)
def raw_stream_oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that carry a whole document, landed as files; the cap is low so that many exceed it."""
    documents = table(spark, sf_dir, "documents")
    message = text(
        '{"channel":"trade","data":[{"price":', F.col("n_chars") + 1, ',"qty":', F.col("doc_id") + 1, ',"note":"',
        F.hex("text"), '"}]}',
    )
    path = scratch_path(spark, "landed")
    documents.select("doc_id", message.alias("raw")).write.parquet(path)
    landed = read_landed(spark, path, form="parquet", schema="doc_id bigint, raw string", streaming=True)
    points = decode_feed(landed, "kraken", as_of_ms=AS_OF_MS, max_bytes=4096)
    told = F.when(F.col("error_code").isNull(), F.lit("small")).otherwise(F.col("raw"))
    out = scratch_path(spark, "decoded")
    writer = shown(points.withColumn("raw", told), "doc_id", raw=True).writeStream.format("parquet")
    writer = writer.option("checkpointLocation", scratch_path(spark, "stream-state")).trigger(availableNow=True)
    run_for(writer.start(out), None)
    return spark.read.parquet(out)
