"""Accepted points and dead letters as rows and text lines."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pointgate.functions import payloads, times
from pointgate.functions.numbers import csv_number, is_finite, json_number
from pointgate.operators import points as P
from pointgate.options import GateOptions, OutputOptions


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == P.ACCEPTED)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == P.REJECTED)


def csv_cells(names: list[str]) -> list[Column]:
    """Text columns of the CSV sink under their header names."""
    cells = [csv_number(F.get("metrics", F.lit(i))).alias(name) for i, name in enumerate(names[1:])]
    return [F.col("timestamp_ns").cast("string").alias(names[0]), *cells]


def _has_feed(opts: OutputOptions) -> Column:
    return F.coalesce(F.col("feed") != "", F.lit(False)) & F.lit(not opts.channel_scoped)


def json_unwritable(width: int | None = None) -> Column:
    """Accepted points that no JSON line can hold: a NaN or infinity let through by the gate."""
    if width is None:
        return F.exists("metrics", lambda m: ~is_finite(m))
    bad = F.lit(False)
    for i in range(width):
        bad = bad | ~F.coalesce(is_finite(F.get("metrics", F.lit(i))), F.lit(True))
    return bad


def json_line(field_count: int, opts: OutputOptions) -> Column:
    """One JSON object per point: timestamp_ns, feed unless scoped, metric_i.  Key order is not promised."""
    metrics = [F.get("metrics", F.lit(i)).alias(f"metric_{i}") for i in range(field_count)]
    feed = F.when(_has_feed(opts), F.col("feed")).alias("feed")
    return F.to_json(F.struct("timestamp_ns", feed, *metrics))


def canonical_line(field_count: int, opts: OutputOptions) -> Column:
    """Byte-stable JSON line: fixed key order, shortest numbers; null when a metric is not finite."""
    feed = F.when(
        _has_feed(opts),
        F.concat(F.lit(',"feed":'), _json_string(F.col("feed"))),
    ).otherwise(F.lit(""))
    parts: list[Column] = [F.lit('{"timestamp_ns":'), F.col("timestamp_ns").cast("string"), feed]
    broken = json_unwritable(field_count)
    for i in range(field_count):
        value = F.get("metrics", F.lit(i))
        number = F.concat(F.lit(f',"metric_{i}":'), json_number(value))
        parts.append(F.when(value.isNull(), F.lit("")).otherwise(number))
    return F.when(~broken, F.concat(*parts, F.lit("}")))


def _json_string(text: Column) -> Column:
    """Text as a JSON string, quotes and control characters escaped."""
    wrapped = F.to_json(F.array(text))
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


@arrow_udf(T.StringType())
def _two(numbers: pa.Array) -> pa.Array:
    """Two decimals, rounded from the exact binary value; each distinct number of a batch is printed once."""
    codes = numbers.dictionary_encode()
    printed = pa.array(["NaN" if v != v else f"{v:.2f}" for v in codes.dictionary.to_pylist()], pa.string())
    return printed.take(codes.indices)


def _two_decimals(number: Column) -> Column:
    """Text of a number under the codes that print decimals; only those numbers leave the JVM."""
    wanted = F.col("reason_code").isin(P.BELOW_MIN, P.ABOVE_MAX, P.SPIKE)
    return F.coalesce(_two(F.when(wanted, number)), F.lit("NaN"))


def _whole(number: Column) -> Column:
    return F.coalesce(number.try_cast("decimal(38,0)").cast("string"), F.lit("0"))


def reason_text(opts: GateOptions | None = None) -> Column:
    """Reason of a rejected record as text."""
    prefix = "Parse Warning: " if opts is not None and not opts.drop_on_parse_error else "Parse Error: "
    detail = F.when(F.col("error_code") == P.CSV_READ_ERROR, F.concat(F.lit("CSV Read Error: "), F.col("parse_error")))
    detail = detail.when(
        F.col("error_code").isin(P.PARSE_ERROR, P.OVERSIZE, P.BAD_TIMESTAMP), F.concat(F.lit(prefix), F.col("parse_error"))
    ).otherwise(F.coalesce("parse_error", "error_code"))
    observed, limit = _two_decimals(F.col("observed")), _two_decimals(F.col("limit_value"))
    metric = F.concat(F.lit("metric_"), F.coalesce(F.col("metric_idx").cast("string"), F.lit("")))
    code = F.col("reason_code")
    # Reason texts.
    return (
        F.when(code == P.NON_FINITE, F.lit("Non-finite metric detected"))
        .when(
            code == P.BELOW_MIN,
            F.concat(F.lit("Value below minimum: "), metric, F.lit("="), observed, F.lit(" < min="), limit),
        )
        .when(
            code == P.ABOVE_MAX,
            F.concat(F.lit("Value exceeds maximum: "), metric, F.lit("="), observed, F.lit(" > max="), limit),
        )
        .when(
            code == P.TOO_FUTURE,
            F.concat(
                F.lit("Timestamp too far in future: "), _whole(F.col("observed")), F.lit("ms ahead of tolerance")
            ),
        )
        .when(
            code == P.TOO_OLD,
            F.concat(
                F.lit("Timestamp too old: "),
                _whole(F.col("observed")),
                F.lit("ms exceeds staleness limit of "),
                _whole(F.col("limit_value")),
                F.lit("ms"),
            ),
        )
        .when(
            code == P.SPIKE,
            F.concat(
                F.lit("Sudden change detected: "),
                metric,
                F.lit(" delta="),
                observed,
                F.lit(" exceeds threshold "),
                limit,
                F.lit(" (baseline="),
                _two_decimals(F.col("baseline")),
                F.lit(")"),
            ),
        )
        .otherwise(F.coalesce(detail, code, F.lit("")))
    )


def shaped_raw(opts: OutputOptions) -> Column:
    """Raw text as the dead letter keeps it: hashed, truncated or whole; never changed for non-finite points."""
    raw = F.coalesce(F.col("raw"), F.lit(""))
    shaped = raw
    if opts.hash_raw:
        shaped = payloads.sha256_hex(raw)
    elif opts.truncate_raw:
        shaped = payloads.truncate_bytes(raw, opts.max_raw_bytes)
    return F.when(F.col("reason_code") == P.NON_FINITE, raw).otherwise(shaped)


def dead_letter_rows(
    df: DataFrame, opts: OutputOptions, gate: GateOptions | None = None, as_of_ms: int | None = None
) -> DataFrame:
    """Rejected records as ``timestamp_ns, reason, raw_record`` plus the typed reason columns."""
    return rejected(df).select(
        F.coalesce(F.col("timestamp_ns"), times.as_of_ns(as_of_ms)).alias("timestamp_ns"),
        reason_text(gate).alias("reason"),
        shaped_raw(opts).alias("raw_record"),
        *("reason_code", "metric_idx", "observed", "limit_value", "baseline"),
    )


def dead_letter_lines(
    df: DataFrame, opts: OutputOptions, gate: GateOptions | None = None, as_of_ms: int | None = None
) -> DataFrame:
    rows = dead_letter_rows(df, opts, gate, as_of_ms)
    return rows.select(F.to_json(F.struct("timestamp_ns", "reason", "raw_record")).alias("value"))
