"""CSV cells, JSON records, typed columns and typed points."""

import math

import pytest
from pyspark.sql import functions as F

from pointgate.operators import normalize as N
from pointgate.operators import points as P
from pointgate.options import PathMapping, PointMapping, TimeSpec

NOW = 1_700_000_000_000
NOW_NS = NOW * 1_000_000


def cells(spark, *rows):
    return spark.createDataFrame(rows, "at string, a string, b string").coalesce(1)


def csv(spark, row, mapping, strict=True):
    return N.normalize_csv(cells(spark, row), mapping, ["at", "a", "b"], strict, NOW).first()


BOTH = PointMapping({"a": 0, "b": 1}, 2, TimeSpec(field="at"))


def test_csv_point(spark):
    got = csv(spark, ("1000", "1.5", "2"), BOTH)
    assert (got.timestamp_ns, got.metrics, got.raw, got.error_code) == (10**9, [1.5, 2.0], "1000|1.5|2", None)


@pytest.mark.parametrize(
    "row,text",
    [
        (("x", "1", "2"), "invalid timestamp value: x"),
        (("-1", "1", "2"), "invalid timestamp value: -1"),
        (("", "1", "2"), "invalid timestamp value: "),
        (("1", "1d", "2"), "Type Error: Could not parse '1d' as f64"),
        (("1", "1", None), "Type Error: Could not parse '' as f64"),
        # The time comes first, then metrics by their position.
        (("x", "y", "z"), "invalid timestamp value: x"),
        (("1", "y", "z"), "Type Error: Could not parse 'y' as f64"),
    ],
)
def test_csv_errors(spark, row, text):
    got = csv(spark, row, BOTH)
    assert (got.error_code, got.parse_error, got.timestamp_ns, got.metrics) == (P.PARSE_ERROR, text, None, None)


def test_csv_nan_is_a_number(spark):
    assert math.isnan(csv(spark, ("1", "NaN", "2"), BOTH).metrics[0])


def test_csv_without_time_is_now(spark):
    assert csv(spark, ("x", "1", "2"), PointMapping({"a": 0, "b": 1}, 2)).timestamp_ns == NOW_NS


def test_csv_before_1970(spark):
    mapping = PointMapping({"a": 0, "b": 1}, 2, TimeSpec(field="at", format="datetime_utc"))
    assert csv(spark, ("1969-12-31 23:59:59", "1", "2"), mapping).parse_error.startswith("datetime before Unix epoch")
    assert csv(spark, ("1970-01-01 00:00:00", "1", "2"), mapping).timestamp_ns == 0


def test_unmapped_metrics(spark):
    mapping = PointMapping({"a": 1}, 2)
    assert csv(spark, ("1", "5", "6"), mapping).parse_error == "Missing Field: Expected 2, got 1"
    assert csv(spark, ("1", "5", "6"), mapping, strict=False).metrics == [0.0, 5.0]


def test_missing_columns(spark):
    assert csv(spark, ("1", "5", "6"), PointMapping({"zz": 0}, 1)).parse_error == "Missing Field: zz"
    late = PointMapping({"a": 0}, 1, TimeSpec(field="when"))
    assert csv(spark, ("1", "5", "6"), late).parse_error == "missing timestamp field: when"


def test_mapping_errors():
    with pytest.raises(ValueError):
        PointMapping({"a": 2}, 2)
    with pytest.raises(ValueError):
        PointMapping({}, 0)
    with pytest.raises(ValueError):
        TimeSpec(unit="h")
    with pytest.raises(ValueError):
        TimeSpec(format="time_utc")


def test_two_field_configs():
    old = {"price_field": "p", "volume_field": "v", "timestamp_unit": "ns"}
    assert PointMapping.from_config(old) == PointMapping({"p": 0, "v": 1}, 2, TimeSpec(unit="ns"))
    new = {**old, "field_count": 1, "field_map": {"x": 0}}
    assert PointMapping.from_config(new).field_map == {"x": 0}
    assert PointMapping.from_config({**old, "field_count": 3}).field_count == 2
    with pytest.raises(ValueError):
        PointMapping.from_config({"price_field": "p"})
    assert PathMapping.from_config({"price_path": "a", "volume_path": "b"}) == PathMapping(("a", "b"))
    assert PathMapping.from_config({"field_paths": ["c"], "price_path": "a", "volume_path": "b"}) == PathMapping(("c",))


def by_map(spark, text, spec=TimeSpec(field="t"), field_map=None, count=1):
    df = spark.createDataFrame([(text,)], "raw string")
    return N.normalize_json_map(df, "raw", PointMapping(field_map or {"v": 0}, count, spec), NOW).first()


def test_json_map(spark):
    assert by_map(spark, '{"v":1,"t":1000.75}').timestamp_ns == 1_000_750_000
    assert by_map(spark, '{"v":1,"t":"1000.75"}').timestamp_ns == 1_000_750_000
    # No time, or one that is no number, means now.
    assert by_map(spark, '{"v":1}').timestamp_ns == NOW_NS
    assert by_map(spark, '{"v":1,"t":"soon"}').timestamp_ns == NOW_NS
    assert by_map(spark, '{"v":1,"t":-1}').parse_error == "invalid timestamp value"
    assert by_map(spark, '{"v":"inf","t":1}').parse_error == "Non-finite value at v"
    assert by_map(spark, '{"w":1,"t":1}').parse_error == "Missing Field: v"
    assert by_map(spark, "{").parse_error == "invalid JSON"
    assert by_map(spark, '{"a":{"v":[7]}}', field_map={"a.v.0": 1}, count=2).metrics == [0.0, 7.0]


def test_json_map_with_format(spark):
    spec = TimeSpec(field="t", format="datetime_utc")
    assert by_map(spark, '{"v":1,"t":"1970-01-01 00:00:01"}', spec).timestamp_ns == 10**9
    assert by_map(spark, '{"v":1,"t":1000}', spec).timestamp_ns == 10**9
    assert "Failed parsing" in by_map(spark, '{"v":1,"t":"1970-01-01"}', spec).parse_error
    assert by_map(spark, '{"v":1,"t":null}', spec).timestamp_ns == NOW_NS


def by_paths(spark, text, ts="t"):
    df = spark.createDataFrame([(text,)], "raw string")
    return N.normalize_json_paths(df, "raw", PathMapping(("v",), ts), NOW).first()


def test_json_paths(spark):
    assert by_paths(spark, '{"v":1,"t":1000.75}').timestamp_ns == 10**9
    assert by_paths(spark, '{"v":1,"t":-5}').timestamp_ns == 0
    assert by_paths(spark, '{"v":1,"t":"1970-01-01 00:00:01.5"}').timestamp_ns == 1_500_000_000
    # Numeric text is no time here.
    assert "Failed parsing" in by_paths(spark, '{"v":1,"t":"1000"}').parse_error
    assert by_paths(spark, '{"v":1,"t":true}').timestamp_ns == NOW_NS
    assert by_paths(spark, '{"v":1,"t":null}').timestamp_ns == NOW_NS
    assert by_paths(spark, '{"v":1}').parse_error == "Missing Field: t"
    assert by_paths(spark, '{"v":1}', None).timestamp_ns == NOW_NS
    assert by_paths(spark, '{"v":true,"t":1}').parse_error == "Missing Field: v"
    assert by_paths(spark, '{"v":"nan","t":1}').parse_error == "Non-finite value at path v"
    assert by_paths(spark, '{"v":1,"t":1e300}').timestamp_ns > 9 * 10**18


def test_custom_feed(spark):
    texts = ['{"v":1,"t":5}', '{"v":1}', '{"t":5}', "{", '{"v":"2","t":"7.9"}', '{"v":"inf","t":-1}', '{"v":1,"t":"nan"}']
    df = spark.createDataFrame([(t,) for t in texts], "raw string").coalesce(1)
    rows = N.normalize_custom_feed(df, "raw", PathMapping(("v",), "t"), NOW).collect()
    got = [(r.raw, r.timestamp_ns, r.metrics, r.error_code) for r in rows]
    assert got == [
        (texts[0], 5_000_000, [1.0], None),
        ("{", None, None, P.PARSE_ERROR),
        (texts[4], 7_000_000, [2.0], None),
        (texts[5], 0, [math.inf], None),
        (texts[6], 0, [1.0], None),
    ]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.5, "1970-01-01 00:00:01"), (None, 2.5, "x"), (3, 4.0, "x")], "a int, b float, at string")
    df = df.coalesce(1)
    spec = TimeSpec(field="at", format="datetime_utc")
    rows = N.normalize_columns(df, PointMapping({"a": 0, "b": 1}, 2, spec), F.lit("r"), NOW).collect()
    assert (rows[0].timestamp_ns, rows[0].metrics) == (10**9, [1.0, 2.5])
    assert rows[1].parse_error == "Missing Field: a"
    assert "Failed parsing" in rows[2].parse_error


def test_column_times(spark):
    df = spark.sql("select 1.0D v, 2 ms, timestamp'1970-01-01 00:00:01.5Z' ts, timestamp_ntz'1970-01-01 00:00:02' ntz, true b")
    def at(field):
        return N.normalize_columns(df, PointMapping({"v": 0}, 1, TimeSpec(field=field)), F.lit(""), NOW).first().timestamp_ns
    assert [at(f) for f in ("ms", "ts", "ntz", "b", "absent", None)] == [
        2_000_000, 1_500_000_000, 2_000_000_000, NOW_NS, NOW_NS, NOW_NS,
    ]


def test_column_schema_errors(spark):
    df = spark.sql("select 1.0D v, 'x' s")
    with pytest.raises(ValueError):
        N.normalize_columns(df, PointMapping({"zz": 0}, 1), F.lit(""))
    with pytest.raises(TypeError):
        N.normalize_columns(df, PointMapping({"s": 0}, 1), F.lit(""))
    with pytest.raises(ValueError):
        N.normalize_columns(df, PointMapping({"v": 0}, 2), F.lit(""))


def test_typed_points(spark):
    df = spark.createDataFrame(
        [(5, [1.0, 2.0]), (0, [1.0]), (-1, [1.0]), (7, []), (8, [math.nan])], "timestamp_ns bigint, metrics array<double>"
    ).coalesce(1)
    rows = N.normalize_typed_points(df, as_of_ms=NOW).collect()
    assert [r.timestamp_ns for r in rows] == [5, NOW_NS, None, 8]
    assert rows[2].error_code == P.BAD_TIMESTAMP
    assert rows[0].raw == "timestamp_ns=5 metrics=[1.0, 2.0]"


def test_filters_on_points_stay_above_the_decoding(spark):
    """Otherwise every document would be parsed once more per filter."""
    df = spark.createDataFrame([('{"v":1}',)], "raw string").filter("raw is not null")
    points = N.normalize_json_paths(df, "raw", PathMapping(("v",)), NOW).filter("error_code is null and metrics[0] > 0")
    plan = points._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json") == 1
