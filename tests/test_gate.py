import math

import pytest
from pyspark.sql import functions as F

from pointgate.operators import gate, points as P
from pointgate.operators.counts import outcome_counts
from pointgate.options import Bound, GateOptions

NOW = 1_700_000_000_000


def opts(**changes):
    return GateOptions(**{"future_tolerance_ms": 1000, "stale_tolerance_ms": 5000, **changes})


def frame(spark, rows):
    """rows of (id, timestamp_ns, metrics)"""
    df = spark.createDataFrame(rows, "id int, timestamp_ns bigint, metrics array<double>").coalesce(1)
    none = F.lit(None).cast("string")
    return df.withColumns({"feed": none, "raw": F.lit("r"), "parse_error": none, "error_code": none})


def judge(spark, metrics, options, ts_ms=NOW, width=None):
    rows = gate.apply_checks(frame(spark, [(1, ts_ms * 1_000_000, metrics)]), options, NOW, width)
    return rows.select("status", *gate.VERDICT_FIELDS).first()


@pytest.mark.parametrize("width", [None, 2])
@pytest.mark.parametrize("bad", [math.nan, math.inf, -math.inf])
def test_non_finite_first(spark, bad, width):
    got = judge(spark, [bad, 1.0], opts(price_min=5.0), width=width)
    assert (got.status, got.reason_code, got.metric_idx) == (P.REJECTED, P.NON_FINITE, None)


def test_nan_passes_bounds_when_allowed(spark):
    got = judge(spark, [math.nan, math.nan], opts(reject_nan_inf=False, price_min=0.0, price_max=1.0))
    assert got.status == P.ACCEPTED


def test_infinity_fails_bounds_when_allowed(spark):
    got = judge(spark, [math.inf], opts(reject_nan_inf=False, price_max=1.0))
    assert (got.reason_code, got.observed) == (P.ABOVE_MAX, math.inf)


def test_bounds_are_strict(spark):
    limits = opts(price_min=1.0, price_max=2.0)
    assert judge(spark, [1.0, 0.0], limits).status == P.ACCEPTED
    assert judge(spark, [2.0, 0.0], limits).status == P.ACCEPTED
    low = judge(spark, [0.5, -1.0], limits)
    assert (low.reason_code, low.metric_idx, low.observed, low.limit_value) == (P.BELOW_MIN, 0, 0.5, 1.0)


def test_second_metric_is_not_negative_by_default(spark):
    got = judge(spark, [1.0, -0.5, -9.0], opts())
    assert (got.reason_code, got.metric_idx, got.limit_value) == (P.BELOW_MIN, 1, 0.0)
    assert judge(spark, [-1.0, 0.0, -9.0], opts()).status == P.ACCEPTED


def test_bound_section_replaces_both_sides(spark):
    limits = opts(price_min=5.0, volume_max=1.0, bounds={0: Bound(max=9.0), 1: Bound(min=-3.0)})
    assert judge(spark, [1.0, -2.0], limits).status == P.ACCEPTED
    assert judge(spark, [1.0, 50.0], limits).status == P.ACCEPTED
    assert judge(spark, [10.0, 0.0], limits).reason_code == P.ABOVE_MAX


def test_bounds_of_absent_metrics(spark):
    assert judge(spark, [1.0], opts(bounds={3: Bound(min=1.0)})).status == P.ACCEPTED


def test_lowest_metric_decides(spark):
    got = judge(spark, [1.0, 2.0, 99.0], opts(bounds={2: Bound(max=5.0), 1: Bound(min=3.0)}))
    assert got.metric_idx == 1


def test_time_limits(spark):
    assert judge(spark, [1.0], opts(), NOW + 1000).status == P.ACCEPTED
    late = judge(spark, [1.0], opts(), NOW + 1001)
    assert (late.reason_code, late.observed) == (P.TOO_FUTURE, 1.0)
    assert judge(spark, [1.0], opts(), NOW - 5000).status == P.ACCEPTED
    old = judge(spark, [1.0], opts(), NOW - 5001)
    assert (old.reason_code, old.observed, old.limit_value) == (P.TOO_OLD, 5001.0, 5000.0)


def test_sub_millisecond_part_is_ignored(spark):
    df = frame(spark, [(1, (NOW + 1000) * 1_000_000 + 999_999, [1.0])])
    assert gate.apply_checks(df, opts(), NOW).first().status == P.ACCEPTED


def test_replay_skips_time(spark):
    assert judge(spark, [1.0], opts(replay_mode=True), 1).status == P.ACCEPTED


def test_clock_is_used_without_as_of(spark):
    df = frame(spark, [(1, NOW * 1_000_000, [1.0])])
    assert gate.apply_checks(df, opts()).first().reason_code == P.TOO_OLD


def test_no_fail_fast_accepts_violations(spark):
    limits = opts(fail_fast=False, price_max=1.0, spike_max_delta={0: 1.0})
    row = gate.apply_checks(frame(spark, [(1, NOW * 1_000_000, [5.0, -1.0])]), limits, NOW).first()
    assert row.status == P.ACCEPTED
    assert [(v.reason_code, v.metric_idx) for v in row.violations] == [(P.ABOVE_MAX, 0), (P.BELOW_MIN, 1)]
    assert judge(spark, [math.nan], limits).reason_code == P.NON_FINITE
    assert judge(spark, [5.0], limits, 1).reason_code == P.TOO_OLD
    assert not limits.spikes_active


def test_no_fail_fast_without_bounds(spark):
    limits = opts(fail_fast=False, bounds={0: Bound(), 1: Bound()})
    row = gate.apply_checks(frame(spark, [(1, NOW * 1_000_000, [5.0])]), limits, NOW).first()
    assert row.violations == []


def test_parse_errors_come_first(spark):
    df = frame(spark, [(1, None, None)]).withColumns({"parse_error": F.lit("bad"), "error_code": F.lit(P.PARSE_ERROR)})
    row = gate.apply_checks(df, opts(), NOW).first()
    assert (row.status, row.reason_code) == (P.REJECTED, P.PARSE_ERROR)


def test_read_error_aborts_only_when_asked(spark):
    df = frame(spark, [(1, None, None)]).withColumns({"parse_error": F.lit("x"), "error_code": F.lit(P.CSV_READ_ERROR)})
    kept = gate.abort_on_read_error(df, opts())
    assert gate.apply_checks(kept, opts(), NOW).first().reason_code == P.CSV_READ_ERROR
    strict = opts(drop_on_parse_error=False)
    with pytest.raises(Exception, match="CSV reading failed"):
        gate.apply_checks(gate.abort_on_read_error(df, strict), strict, NOW).collect()
    other = df.withColumn("error_code", F.lit(P.PARSE_ERROR))
    assert gate.apply_checks(gate.abort_on_read_error(other, strict), strict, NOW).first().status == P.REJECTED


def test_counts(spark):
    df = frame(spark, [(i, NOW * 1_000_000, [float(i), 0.0]) for i in range(10)])
    row = outcome_counts(gate.apply_checks(df, opts(price_max=6.0), NOW)).first()
    assert (row.accepted, row.dropped) == (7, 3)


def test_alpha():
    assert opts().alpha == 0.05
    assert opts(burst_ema_alpha=0.2).alpha == 0.2
    assert opts(burst_ema_alpha=0.2, spike_max_delta={0: 1.0}).alpha == 0.05
    assert opts(ema_alpha=0.3, spike_max_delta={0: 1.0}).alpha == 0.3


def test_no_shuffle_and_no_python_in_the_stateless_gate(spark):
    df = frame(spark, [(1, 1, [1.0])])
    plan = gate.apply_checks(df, opts(price_max=1.0), NOW, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
