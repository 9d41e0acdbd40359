"""Kafka-shaped rows, datagrams, pages, CSV bodies, change rows, syslog."""

import json

import pytest
from pyspark.sql import functions as F

from pointgate.operators import points as P
from pointgate.operators.changes import decode_change_rows, last_position, position_number
from pointgate.operators.syslog import decode_syslog
from pointgate.options import PathMapping
from pointgate.sources import messages as M

NOW = 1_700_000_000_000
NOW_NS = NOW * 1_000_000


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, raw string").coalesce(1)


def test_kafka(spark):
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
    rows = [(None, v, "t", 0, i, None) for i, v in enumerate([b'{"v":1}', None, b"\xff\xfe", b"{", b'{"v":"x"}'])]
    got = M.decode_kafka(spark.createDataFrame(rows, schema).coalesce(1), PathMapping(("v",)), NOW).collect()
    assert [(r.offset, r.error_code, r.parse_error, r.raw) for r in got] == [
        (0, None, None, '{"v":1}'),
        (2, P.PARSE_ERROR, "invalid UTF-8", ""),
        (3, P.PARSE_ERROR, "invalid JSON", "{"),
        (4, P.PARSE_ERROR, "Missing Field: v", '{"v":"x"}'),
    ]


def test_datagrams(spark):
    got = M.decode_datagrams(texts(spark, "", ' {"v":1}\n', "  "), PathMapping(("v",)), as_of_ms=NOW).collect()
    assert [(r.n, r.error_code) for r in got] == [(1, None), (2, P.PARSE_ERROR)]


def pages(spark, *bodies, **how):
    df = spark.createDataFrame([(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "page_no int, body string")
    rows = M.decode_pages(df.repartition(3), PathMapping(("v",)), as_of_ms=NOW, **how).collect()
    return sorted((r.page_no, r.item_no, r.metrics[0] if r.metrics else None) for r in rows)


def test_pages(spark):
    assert pages(spark, [{"v": 1}, {"w": 1}, {"v": 3}], {"v": 4}) == [(0, 0, 1.0), (0, 1, None), (0, 2, 3.0), (1, 0, 4.0)]


@pytest.mark.parametrize("stop", [[], [{"w": 1}], {"w": 1}, "not json", "5"])
def test_pages_stop_at_the_first_empty_one(spark, stop):
    assert pages(spark, [{"v": 1}], stop, [{"v": 3}]) == [(0, 0, 1.0)]


def test_pages_stop_at_a_missing_cursor(spark):
    page = lambda v, c: {"v": v, "meta": {"next": c}}
    assert pages(spark, page(1, "a"), page(2, 7), page(3, "c"), cursor_path="meta.next") == [(0, 0, 1.0), (1, 0, 2.0)]
    assert pages(spark, {"v": 1}, {"v": 2}, cursor_path="meta.next") == [(0, 0, 1.0)]


def test_page_limit(spark):
    assert pages(spark, {"v": 1}, {"v": 2}, {"v": 3}, max_pages=2) == [(0, 0, 1.0), (1, 0, 2.0)]


@pytest.mark.parametrize(
    "body,want",
    [
        ("a,b\n1,2\n3,4", [2.0, 1.0]),
        ("a,b\r\n1,2", [2.0, 1.0]),
        ('"a","b"\n"1","2"', [2.0, 1.0]),
        ('x,"b","a"\n"q, ""r""\nz",2,1', [2.0, 1.0]),
        ("a,b\n1,2,3", None),
        ("a,b\n1", None),
        ("a,c\n1,2", None),
        ("a,b", None),
        ("", None),
        ("a,b\n1, 2", None),
        ("a,b\n1,x", None),
    ],
)
def test_csv_bodies(spark, body, want):
    got = M.decode_csv_bodies(texts(spark, body), ["b", "a"], "raw", NOW).first()
    assert (got.metrics, got.error_code) == (want, None if want else P.PARSE_ERROR)


def test_long_csv_body(spark):
    body = "a,b\n" + '"' + "x" * 200_000 + '",5\n' + "1,2\n" * 20_000
    assert M.decode_csv_bodies(texts(spark, body), ["b"], "raw", NOW).first().metrics == [5.0]


def change(action, columns, **more):
    names = [{"name": k, "type": "t", "value": v} for k, v in columns.items()]
    return json.dumps({"action": action, "schema": "s", "table": "t", "columns": names, **more})


def test_change_rows(spark):
    rows = [
        change("I", {"p": 1.5, "t": 7}),
        change("U", {"p": "2.5", "t": "1970-01-01 00:00:01"}),
        change("I", {"t": 7}, p=4),
        change("I", {"p": None, "t": 7}, p=4),
        change("I", {"p": 1, "t": None}),
        '{"action":"B"}',
        '{"action":"D","identity":[]}',
        change("T", {"p": 1, "t": 1}),
        "  ",
        "{",
        change("I", {"t": 7}),
        change("I", {"p": 1}),
        change("I", {"p": "inf", "t": 1}),
    ]
    got = decode_change_rows(texts(spark, *rows), "raw", PathMapping(("p",), "t"), NOW).collect()
    assert [(r.n, r.metrics, r.timestamp_ns, r.parse_error) for r in got] == [
        (0, [1.5], 7_000_000, None),
        (1, [2.5], 10**9, None),
        (2, [4.0], 7_000_000, None),
        (3, [4.0], 7_000_000, None),
        (4, [1.0], NOW_NS, None),
        (9, None, None, "cdc change data is not JSON"),
        (10, None, None, "Missing Field: p"),
        (11, None, None, "Missing Field: t"),
        (12, None, None, "Non-finite value at path p"),
    ]


def test_last_position(spark):
    df = texts(spark, "0/10", "1/5", " ", None)
    assert last_position(df, "raw", ["n"]).first()[0] == "1/5"
    blank = texts(spark, "", None)
    assert last_position(blank, "raw", ["n"]).first()[0] == "0/0"
    assert last_position(blank, "raw", ["n"], restart="0/AA").first()[0] == "0/AA"


def test_position_number(spark):
    df = texts(spark, "0/10", "A/FF")
    assert [int(r[0]) for r in df.select(position_number(F.col("raw"))).collect()] == [16, 10 * 2**32 + 255]


def test_syslog(spark):
    lines = ["<34>1 1970-01-01T00:00:01.5Z host app - - m\r\n", "<34>1 - host", "", "\r\n", "plain", "<3>1 1970-01-01T01:00:01+01:00"]
    got = decode_syslog(texts(spark, *lines), "raw", "RFC5424", 2, as_of_ms=NOW).collect()
    assert [(r.n, r.timestamp_ns, r.metrics) for r in got] == [
        (0, 1_500_000_000, [1.0, 1.0]), (1, NOW_NS, [1.0, 1.0]), (4, NOW_NS, [1.0, 1.0]), (5, 10**9, [1.0, 1.0]),
    ]
    assert got[0].raw == "<34>1 1970-01-01T00:00:01.5Z host app - - m"


def test_old_syslog(spark):
    lines = ["<34>Jan  2 00:00:01 host tag: m", "<34>Feb 29 00:00:00 h", "<34>Foo 1 00:00:00 h", "<34>Jan 2 00:00 h"]
    got = decode_syslog(texts(spark, *lines), "raw", "rfc3164", 0, year=1970, as_of_ms=NOW).collect()
    assert [r.timestamp_ns for r in got] == [86_401 * 10**9, NOW_NS, NOW_NS, NOW_NS]
    assert got[0].metrics == [1.0]
    this_year = decode_syslog(texts(spark, lines[0]), "raw", "rfc3164", 1, as_of_ms=NOW).first()
    assert this_year.timestamp_ns == 1_672_617_601 * 10**9  # 2023, the year of the run
