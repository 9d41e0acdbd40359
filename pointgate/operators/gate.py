"""The stateless checks, as one chain of column expressions.

Order: parse errors, finite, bounds (ascending metric, min before max), too far in the future, too old.
The first failure decides.  The stateful spike check follows in ``operators.spike``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.functions import times
from pointgate.operators import points as P
from pointgate.options import GateOptions

VERDICT_TYPE = "struct<reason_code:string,metric_idx:int,observed:double,limit_value:double,baseline:double>"
VERDICT_FIELDS = ("reason_code", "metric_idx", "observed", "limit_value", "baseline")


def _verdict(code: Column | str, metric: int | None = None, observed=None, limit=None) -> Column:
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        (code if isinstance(code, Column) else F.lit(code)).alias("reason_code"),
        F.lit(metric).cast("int").alias("metric_idx"),
        value(observed).cast("double").alias("observed"),
        value(limit).cast("double").alias("limit_value"),
        F.lit(None).cast("double").alias("baseline"),
    )


def _has_non_finite(width: int | None) -> Column:
    """Any NaN or infinity.  A known width keeps the check in generated code."""
    infinity = F.lit(float("inf"))
    bad = lambda m: F.isnan(m) | (F.abs(m) == infinity)
    if width is None:
        return F.exists("metrics", bad)
    any_bad = F.lit(False)
    for i in range(width):
        any_bad = any_bad | F.coalesce(bad(F.get("metrics", F.lit(i))), F.lit(False))
    return any_bad


def _bound_checks(opts: GateOptions) -> list[tuple[Column, Column]]:
    checks = []
    for index in opts.bounded_metrics():
        low, high = opts.metric_bounds(index)
        value = F.get("metrics", F.lit(index))
        # NaN passes bounds: it is neither below nor above anything, while Spark ranks it above all.
        number = ~F.isnan(value)
        if low is not None:
            checks.append((number & (value < F.lit(float(low))), _verdict(P.BELOW_MIN, index, value, low)))
        if high is not None:
            checks.append((number & (value > F.lit(float(high))), _verdict(P.ABOVE_MAX, index, value, high)))
    return checks


def _time_checks(opts: GateOptions, as_of_ms: Column) -> list[tuple[Column, Column]]:
    ts_ms = times.to_ms(F.col("timestamp_ns"))
    latest = F.coalesce(F.try_add(as_of_ms, F.lit(opts.future_tolerance_ms)), F.lit(times.BIGINT_MAX))
    age = F.greatest(as_of_ms - ts_ms, F.lit(0).cast("bigint"))
    return [
        (ts_ms > latest, _verdict(P.TOO_FUTURE, None, ts_ms - latest, opts.future_tolerance_ms)),
        (age > F.lit(opts.stale_tolerance_ms), _verdict(P.TOO_OLD, None, age, opts.stale_tolerance_ms)),
    ]


def _first(checks: list[tuple[Column, Column]]) -> Column:
    chain = None
    for bad, verdict in checks:
        chain = F.when(bad, verdict) if chain is None else chain.when(bad, verdict)
    return F.lit(None).cast(VERDICT_TYPE) if chain is None else chain


def apply_checks(
    df: DataFrame, opts: GateOptions, as_of_ms: int | None = None, width: int | None = None
) -> DataFrame:
    """Add ``status`` and the typed reason to a point frame.  Adds no shuffle.

    ``width`` is the number of metrics when all points have the same; ``as_of_ms`` replaces the clock.
    With ``fail_fast`` off, bound violations are listed in ``violations`` and the record is accepted.
    """
    failed = F.col("error_code").isNotNull()
    checks: list[tuple[Column, Column]] = [(failed, _verdict(F.col("error_code")))]
    if opts.reject_nan_inf:
        checks.append((_has_non_finite(width), _verdict(P.NON_FINITE)))
    bounds = _bound_checks(opts)
    if opts.fail_fast:
        checks += bounds
    if not opts.replay_mode:
        checks += _time_checks(opts, times.as_of_ms_col(as_of_ms))
    added = {"__verdict": _first(checks)}
    if not opts.fail_fast:
        listed = [F.when(bad, verdict) for bad, verdict in bounds]
        empty = F.array().cast(f"array<{VERDICT_TYPE}>")
        added["violations"] = F.array_compact(F.array(*listed)) if listed else empty
    judged = df.withColumns(added)
    verdict = F.col("__verdict")
    return judged.withColumns(
        {
            "status": F.when(verdict.isNull(), F.lit(P.ACCEPTED)).otherwise(F.lit(P.REJECTED)),
            **{name: verdict[name] for name in VERDICT_FIELDS},
        }
    ).drop("__verdict")


def abort_on_read_error(df: DataFrame, opts: GateOptions) -> DataFrame:
    """With ``drop_on_parse_error`` off, an unreadable CSV record ends the run; other errors never do."""
    if opts.drop_on_parse_error:
        return df
    stop = F.raise_error(F.concat(F.lit("CSV reading failed: "), F.coalesce("parse_error", F.lit(""))))
    checked = F.when(F.col("error_code") == P.CSV_READ_ERROR, stop.cast("string")).otherwise(F.col("error_code"))
    return df.withColumn("error_code", checked)
