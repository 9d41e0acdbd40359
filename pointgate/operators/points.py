"""The point frame every operator speaks.

``timestamp_ns BIGINT, metrics ARRAY<DOUBLE>, feed STRING, raw STRING, parse_error STRING`` and, for the
few failures that are not parse errors, ``error_code STRING``.  Other columns (ordering, keys) travel along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARSE_ERROR = "PARSE_ERROR"
CSV_READ_ERROR = "CSV_READ_ERROR"
OVERSIZE = "OVERSIZE"
BAD_TIMESTAMP = "BAD_TIMESTAMP"
UNKNOWN_FEED = "UNKNOWN_FEED"
FILE_READ_ERROR = "FILE_READ_ERROR"
NON_FINITE = "NON_FINITE"
BELOW_MIN = "BELOW_MIN"
ABOVE_MAX = "ABOVE_MAX"
TOO_FUTURE = "TOO_FUTURE"
TOO_OLD = "TOO_OLD"
SPIKE = "SPIKE"

ACCEPTED = "accepted"
REJECTED = "rejected"

POINT_COLUMNS = ("timestamp_ns", "metrics", "feed", "raw", "parse_error", "error_code")


def first_error(*checks: tuple[Column, Column | str]) -> Column:
    """Text of the first failing check, null when all hold."""
    texts = [F.when(bad, text if isinstance(text, Column) else F.lit(text)) for bad, text in checks]
    return F.coalesce(*texts) if texts else F.lit(None).cast("string")


def with_point(
    df: DataFrame,
    timestamp_ns: Column,
    metrics: Column,
    raw: Column,
    feed: Column | None = None,
    parse_error: Column | None = None,
    error_code: Column | None = None,
    keep: Column | None = None,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Put the point columns on a frame, for the rows to ``keep``.

    Time and metrics are null where the record has an error.  The point is built as a list of at most one
    element and unnested: rows are dropped where they were decoded, and later filters on point columns are
    not moved below the decoding, which would repeat it.
    """
    none = F.lit(None).cast("string")
    error = none if parse_error is None else parse_error
    df = df.withColumn("__error", error)
    code = F.when(F.col("__error").isNotNull(), F.lit(PARSE_ERROR)) if error_code is None else error_code
    df = df.withColumn("__code", code)
    good = F.col("__code").isNull()
    values = {
        "timestamp_ns": F.when(good, timestamp_ns.cast("bigint")),
        "metrics": F.when(good, metrics.cast("array<double>")),
        "feed": none if feed is None else feed,
        "raw": raw.cast("string"),
        "parse_error": F.col("__error"),
        "error_code": F.col("__code"),
    }
    carried = [F.col(f"`{c}`") for c in df.columns if c not in (*drop, *POINT_COLUMNS, "__error", "__code")]
    kept = {} if keep is None else {"__keep": keep}
    staged = df.select(
        *carried,
        *[value.alias(f"__point_{name}") for name, value in values.items()],
        *[value.alias(name) for name, value in kept.items()],
    )
    # Built from plain columns: nothing is evaluated twice, and no filter on the list is inferred below.
    point = F.array(F.struct(*[F.col(f"__point_{name}").alias(name) for name in values]))
    return staged.select(*carried, F.inline(F.when(F.col("__keep"), point) if kept else point))


def metric_columns(names: list[str]) -> list[Column]:
    """Flatten ``metrics`` into named columns (a missing position is null)."""
    return [F.get("metrics", F.lit(i)).alias(name) for i, name in enumerate(names)]


def output_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``timestamp_ns`` and the metrics under their output names."""
    return df.select(F.col("timestamp_ns").alias(names[0]), *metric_columns(names[1:]))
