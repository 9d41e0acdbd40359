import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from pointgate.operators import points as P
from pointgate.operators.gate import apply_checks
from pointgate.options import GateOptions, LimitOptions, OutputOptions, PointMapping, TimeSpec
from pointgate.plans.run import gate_points, run_batch
from pointgate.sinks import render
from pointgate.sinks import write as W
from pointgate.sources.files import FILE_ORDER, csv_points, read_csv

NOW = 1_700_000_000_000
NOW_NS = NOW * 1_000_000


def opts(**changes):
    return GateOptions(**{"future_tolerance_ms": 1000, "stale_tolerance_ms": 5000, **changes})


def frame(spark, rows):
    """rows of (timestamp_ns, metrics, feed, raw, parse_error, error_code)"""
    schema = "timestamp_ns bigint, metrics array<double>, feed string, raw string, parse_error string, error_code string"
    return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], schema).coalesce(1)


def canonical(spark, row, width, **how):
    df = frame(spark, [row])
    return df.select(render.canonical_line(width, OutputOptions(format="canonical_jsonl", **how))).first()[0]


def test_canonical_lines(spark):
    assert canonical(spark, (42, [1.25, 2.0, 3.5]), 3) == '{"timestamp_ns":42,"metric_0":1.25,"metric_1":2.0,"metric_2":3.5}'
    point = (99, [1.0, 2.0], "trade")
    assert canonical(spark, point, 2) == '{"timestamp_ns":99,"feed":"trade","metric_0":1.0,"metric_1":2.0}'
    assert canonical(spark, point, 2, channel_scoped=True) == '{"timestamp_ns":99,"metric_0":1.0,"metric_1":2.0}'
    assert canonical(spark, (1, [1.0], ""), 1) == '{"timestamp_ns":1,"metric_0":1.0}'
    assert canonical(spark, (1, [1.0], 'a"b\n'), 1) == '{"timestamp_ns":1,"feed":"a\\"b\\n","metric_0":1.0}'
    assert canonical(spark, (1, [1.25, math.nan]), 2) is None
    # Feeds may be narrower than the widest one.
    assert canonical(spark, (1, [5.0]), 3) == '{"timestamp_ns":1,"metric_0":5.0}'


def test_json_lines(spark):
    df = frame(spark, [(5, [1.0, 1e7], "trade")])
    assert json.loads(df.select(render.json_line(2, OutputOptions(format="jsonl"))).first()[0]) == {
        "timestamp_ns": 5, "feed": "trade", "metric_0": 1.0, "metric_1": 1e7,
    }
    assert "feed" not in df.select(render.json_line(2, OutputOptions(channel_scoped=True))).first()[0]


def test_headers():
    assert OutputOptions().header_names(2) == ["timestamp_ns", "price", "volume"]
    assert OutputOptions().header_names(3) == ["timestamp_ns", "metric_0", "metric_1", "metric_2"]
    assert OutputOptions(headers=("a",)).header_names(1) == ["timestamp_ns", "a"]
    with pytest.raises(ValueError):
        OutputOptions(format="xml")


def reasons(spark, rows, options):
    judged = apply_checks(frame(spark, rows), options, NOW)
    return [r[0] for r in judged.filter("status = 'rejected'").select(render.reason_text(options)).collect()]


def test_reason_texts(spark):
    limits = opts(price_min=1.0, price_max=2.675)
    rows = [
        (NOW_NS, [math.nan]),
        (NOW_NS, [0.125]),
        (NOW_NS, [math.inf]),
        (NOW_NS + 1_500_000_000, [2.0]),
        (NOW_NS - 6_000_000_000, [2.0]),
        (None, None, None, "r", "Missing Field: x", P.PARSE_ERROR),
        (None, None, None, "", "ragged", P.CSV_READ_ERROR),
    ]
    assert reasons(spark, rows, limits)[:2] == ["Non-finite metric detected", "Value below minimum: metric_0=0.12 < min=1.00"]
    assert reasons(spark, rows, limits)[3:] == [
        "Timestamp too far in future: 500ms ahead of tolerance",
        "Timestamp too old: 6000ms exceeds staleness limit of 5000ms",
        "Parse Error: Missing Field: x",
        "CSV Read Error: ragged",
    ]
    # Rounded from the exact binary value: 2.675 is a little less than it looks.
    high = opts(price_max=2.675, reject_nan_inf=False)
    assert reasons(spark, [(NOW_NS, [math.inf]), (NOW_NS, [3.005])], high) == [
        "Value exceeds maximum: metric_0=inf > max=2.67", "Value exceeds maximum: metric_0=3.00 > max=2.67",
    ]
    warn = opts(drop_on_parse_error=False)
    assert reasons(spark, [(None, None, None, "r", "x", P.PARSE_ERROR)], warn) == ["Parse Warning: x"]


def test_spike_reason(spark):
    limits = opts(spike_max_delta={0: 10.0})
    df = frame(spark, [(NOW_NS, [10.0]), (NOW_NS + 1, [30.5])]).withColumn("k", F.lit("a"))
    gated = gate_points(df, limits, "k", ["timestamp_ns"], NOW)
    text = gated.filter("status = 'rejected'").select(render.reason_text(limits)).first()[0]
    assert text == "Sudden change detected: metric_0 delta=20.50 exceeds threshold 10.00 (baseline=10.00)"


RAW = "é" * 300  # 600 bytes


@pytest.mark.parametrize(
    "how,want",
    [
        ({}, RAW),
        ({"truncate_raw": True}, "é" * 256 + " (truncated)"),
        ({"truncate_raw": True, "max_raw_bytes": 5}, "éé� (truncated)"),
        ({"truncate_raw": True, "max_raw_bytes": 600}, RAW),
        ({"hash_raw": True, "truncate_raw": True}, hashlib.sha256(RAW.encode()).hexdigest()),
    ],
)
def test_raw_shapes(spark, how, want):
    rows = [(None, None, None, RAW, "x", P.PARSE_ERROR), (NOW_NS, [math.nan], None, RAW)]
    judged = apply_checks(frame(spark, rows), opts(), NOW)
    dead = render.dead_letter_rows(judged, OutputOptions(**how), as_of_ms=NOW).collect()
    assert dead[0].raw_record == want
    # Evidence of non-finite points is never changed.
    assert dead[1].raw_record == RAW
    assert [d.timestamp_ns for d in dead] == [NOW_NS, NOW_NS]


@pytest.mark.parametrize("data", [b"a\xe2\x82", b"\xf0\x9f\x98\x80\xf0\x9f", b"\xc3\x28", b"\xe0\x80\x80x", b"\xed\xa0\x80"])
def test_lossy_text_matches_python(spark, data):
    from pointgate.functions.payloads import lossy_text

    got = spark.createDataFrame([(bytearray(data),)], "b binary").select(lossy_text(F.col("b"))).first()[0]
    assert got == data.decode("utf-8", "replace")


def test_non_finite_points_go_to_the_dead_letter_of_json_sinks(spark, tmp_path):
    loose = opts(reject_nan_inf=False)
    df = apply_checks(frame(spark, [(NOW_NS, [math.nan, 1.0], "a"), (NOW_NS, [1.0, 1.0], "a")]), loose, NOW)
    for form, bad in (("canonical_jsonl", 1), ("jsonl", 1), ("csv", 0), ("parquet", 0)):
        good_path, bad_path = str(tmp_path / form / "good"), str(tmp_path / form / "bad")
        W.write_both(df, good_path, bad_path, 2, OutputOptions(format=form), loose, NOW)
        assert spark.read.text(bad_path).count() == bad
    assert "NaN" in spark.read.option("header", True).csv(str(tmp_path / "csv" / "good")).toPandas()["price"].tolist()


def test_unknown_feeds_are_quarantined(spark):
    routes = OutputOptions(prefix_by_feed={"trade": "t"}, path_by_feed={"ticker": "x"})
    assert routes.routes == {"trade": "t"}
    df = apply_checks(frame(spark, [(NOW_NS, [1.0], f) for f in ("trade", "ticker", None, "")]), opts(), NOW)
    rows = W.quarantine_unwritable(df, routes).collect()
    assert [r.status for r in rows] == [P.ACCEPTED] + [P.REJECTED] * 3
    assert {r.reason_code for r in rows[1:]} == {P.UNKNOWN_FEED}


def test_each_feed_has_its_own_output(spark, tmp_path):
    routes = OutputOptions(format="canonical_jsonl", prefix_by_feed={"trade": "t", "ticker": "q"}, channel_scoped=True)
    df = apply_checks(frame(spark, [(NOW_NS, [1.0, 2.0], "trade"), (NOW_NS, [3.0, 4.0], "ticker")]), opts(), NOW)
    W.write_accepted(df, str(tmp_path / "o"), 2, routes, NOW)
    line = spark.read.text(str(tmp_path / "o" / "route=t")).first()[0]
    assert line == f'{{"timestamp_ns":{NOW_NS},"metric_0":1.0,"metric_1":2.0}}'
    assert spark.read.text(str(tmp_path / "o" / "route=q")).count() == 1


def test_daily_folders(spark, tmp_path):
    df = apply_checks(frame(spark, [(NOW_NS, [1.0, 2.0], "a")]), opts(), NOW)
    W.write_accepted(df, str(tmp_path / "o"), 2, OutputOptions(format="csv", daily=True), NOW)
    assert [p.name for p in (tmp_path / "o").iterdir() if p.is_dir()] == ["day=2023-11-14"]


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_header_mismatch_on_append(spark, tmp_path, form):
    df = apply_checks(frame(spark, [(NOW_NS, [1.0, 2.0], "a")]), opts(), NOW)
    path = str(tmp_path / "o")
    W.write_accepted(df, path, 2, OutputOptions(format=form))
    W.write_accepted(df, path, 2, OutputOptions(format=form))
    assert (spark.read.option("header", True).csv(path) if form == "csv" else spark.read.parquet(path)).count() == 2
    with pytest.raises(ValueError, match="header mismatch"):
        W.write_accepted(df, path, 2, OutputOptions(format=form, headers=("x", "y")))


def test_run_with_a_record_limit(spark, tmp_path):
    lines = "timestamp_ns,price,volume\n" + "".join(f"{10**18 + i},{i + 1}.5,{i}\n" for i in range(5))
    (tmp_path / "in.csv").write_text(lines)
    mapping = PointMapping.price_volume("price", "volume", TimeSpec(field="timestamp_ns", unit="ns"))
    points = csv_points(read_csv(spark, str(tmp_path / "in.csv")), mapping)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    counted = run_batch(
        points, opts(replay_mode=True), OutputOptions(format="csv"), good, bad, 2,
        order=FILE_ORDER, limits=LimitOptions(max_records=2),
    )
    assert counted == {"accepted": 2, "dropped": 0}
    rows = spark.read.option("header", True).csv(good).collect()
    assert sorted((r.timestamp_ns, r.price, r.volume) for r in rows) == [
        ("1000000000000000000", "1.5", "0"), ("1000000000000000000", "2.5", "1"),
    ]


@pytest.mark.parametrize("limit,last", [(1, 1), (3, 5), (5, 9), (6, 9), (0, None)])
def test_limits(spark, limit, last):
    """Rows 1, 3, 5, ... are accepted; rejected rows before the last accepted one are kept, later ones are not."""
    from pointgate.operators.limits import limit_accepted

    df = spark.range(10).selectExpr("id", "if(id % 2 = 1, 'accepted', 'rejected') status").repartition(3)
    for how in ({"top_rows": 0}, {}):
        got = sorted(r.id for r in limit_accepted(df, limit, ["id"], part_rows=2, **how).collect())
        assert got == ([] if last is None else list(range(last + 1)))


def test_limit_with_the_clock(spark):
    """Points that cross a tolerance between two jobs must be judged alike in both."""
    import time

    from pointgate.options import GateOptions, LimitOptions
    from pointgate.plans.run import gate_points

    now = int(time.time() * 1000)
    points = spark.range(1000).selectExpr(
        "id", f"({now} + id) * 1000000 timestamp_ns", "array(1.0D, 1.0D) metrics", "cast(null as string) feed",
        "'' raw", "cast(null as string) parse_error", "cast(null as string) error_code",
    )
    gated = gate_points(
        points, GateOptions(60_000, 2_500), None, ["id"], limits=LimitOptions(max_records=500), width=2
    )
    time.sleep(4)
    assert gated.filter("status = 'accepted'").count() == 500


def test_counters_say_what_was_written(spark, tmp_path):
    from pointgate.options import GateOptions, OutputOptions
    from pointgate.plans.run import run_batch

    rows = [(1, "a", 1.0), (2, "b", 1.0), (3, "a", float("nan"))]
    points = spark.createDataFrame(rows, "id long, feed string, v double").selectExpr(
        "id", "1000000000000000000L timestamp_ns", "array(v, 1.0D) metrics", "feed", "'' raw",
        "cast(null as string) parse_error", "cast(null as string) error_code",
    )
    output = OutputOptions(format="jsonl", prefix_by_feed={"a": "out"})
    gate = GateOptions(2**64 - 1, 2**63 - 1, reject_nan_inf=False)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    assert run_batch(points, gate, output, good, bad, 2) == {"accepted": 1, "dropped": 2}
    assert spark.read.text(good).count() == 1 and spark.read.text(bad).count() == 2
