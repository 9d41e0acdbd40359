"""Writing a gated frame: every record goes to exactly one of the two outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.functions import times
from pointgate.operators import points as P
from pointgate.options import GateOptions, OutputOptions
from pointgate.session import path_exists, staged
from pointgate.sinks import render


def quarantine_unwritable(df: DataFrame, opts: OutputOptions, field_count: int | None = None) -> DataFrame:
    """Move accepted records the sink cannot take to the dead letter: unknown feeds, numbers JSON lacks."""
    ok = F.col("status") == P.ACCEPTED
    code = F.lit(None).cast("string")
    if opts.format in ("jsonl", "canonical_jsonl"):
        code = F.when(render.json_unwritable(field_count), F.lit(P.NON_FINITE))
    if opts.routes:
        known = F.coalesce(F.col("feed").isin(list(opts.routes)), F.lit(False))
        code = F.when(~known, F.lit(P.UNKNOWN_FEED)).otherwise(code)
    moved = ok & code.isNotNull()
    return df.withColumns(
        {
            "status": F.when(moved, F.lit(P.REJECTED)).otherwise(F.col("status")),
            "reason_code": F.when(moved, code).otherwise(F.col("reason_code")),
            "error_code": F.when(moved, code).otherwise(F.col("error_code")),
        }
    )


def route_column(opts: OutputOptions) -> Column:
    """Output name of a point's feed; the mapping is a literal, no join."""
    route = F.lit(None).cast("string")
    for feed, name in opts.routes.items():
        route = F.when(F.col("feed") == feed, F.lit(name)).otherwise(route)
    return route


def _partitions(df: DataFrame, opts: OutputOptions, as_of_ms: int | None, by_event_day: bool):
    columns: dict[str, Column] = {}
    if opts.routes:
        columns["route"] = route_column(opts)
    if opts.daily:
        day = F.col("timestamp_ns") if by_event_day else times.as_of_ns(as_of_ms)
        columns["day"] = F.date_format(times.utc_day(day), "yyyy-MM-dd")
    return columns


def accepted_frame(df: DataFrame, field_count: int, opts: OutputOptions) -> DataFrame:
    """Output columns (or one text column) of accepted points; ``route`` and ``day`` are kept when present."""
    extra = [c for c in ("route", "day") if c in df.columns]
    if opts.format == "canonical_jsonl":
        return df.select(render.canonical_line(field_count, opts).alias("value"), *extra)
    if opts.format == "jsonl":
        return df.select(render.json_line(field_count, opts).alias("value"), *extra)
    names = opts.header_names(field_count)
    if opts.format == "csv":
        return df.select(*render.csv_cells(names), *extra)
    cells = P.metric_columns(names[1:])
    feed = [] if opts.channel_scoped else ["feed"]
    return df.select(F.col("timestamp_ns").alias(names[0]), *feed, *cells, *extra)


def check_headers(df: DataFrame, path: str, opts: OutputOptions) -> None:
    """Appending to a table whose columns differ is an error before anything is written."""
    spark = df.sparkSession
    if opts.format not in ("csv", "parquet") or not path_exists(spark, path):
        return
    reader = spark.read.option("header", True)
    existing = (reader.csv(path) if opts.format == "csv" else reader.parquet(path)).columns
    if existing and existing != df.columns:
        raise ValueError(f"header mismatch: existing {existing}, expected {df.columns}")


def write_accepted(
    df: DataFrame,
    path: str,
    field_count: int,
    opts: OutputOptions,
    as_of_ms: int | None = None,
    by_event_day: bool = False,
    mode: str = "append",
) -> None:
    """Write the accepted records of a gated frame, split by feed route and day when asked."""
    extra = _partitions(df, opts, as_of_ms, by_event_day)
    rows = accepted_frame(render.accepted(df).withColumns(extra) if extra else render.accepted(df), field_count, opts)
    if mode == "append":
        check_headers(rows, path, opts)
    writer = rows.write.mode(mode)
    if extra:
        writer = writer.partitionBy(*extra)
    if opts.format == "csv":
        writer.option("header", True).csv(path)
    elif opts.format == "parquet":
        writer.parquet(path)
    else:
        writer.text(path)


def write_dead_letter(
    df: DataFrame,
    path: str,
    opts: OutputOptions,
    gate: GateOptions | None = None,
    as_of_ms: int | None = None,
    as_text: bool = True,
    mode: str = "append",
) -> None:
    if as_text:
        render.dead_letter_lines(df, opts, gate, as_of_ms).write.mode(mode).text(path)
    else:
        render.dead_letter_rows(df, opts, gate, as_of_ms).write.mode(mode).parquet(path)


def write_both(
    df: DataFrame,
    accepted_path: str,
    dead_letter_path: str,
    field_count: int,
    opts: OutputOptions,
    gate: GateOptions | None = None,
    as_of_ms: int | None = None,
    mode: str = "append",
    dead_letter_text: bool = True,
) -> None:
    """Evaluate the frame once and write both outputs.

    The judged frame is staged in the shared folder between the two writes, so a lost executor repeats neither.
    """
    gated = staged(quarantine_unwritable(df, opts, field_count), "judged")
    write_accepted(gated, accepted_path, field_count, opts, as_of_ms, mode=mode)
    write_dead_letter(gated, dead_letter_path, opts, gate, as_of_ms, dead_letter_text, mode)
