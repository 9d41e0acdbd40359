"""Database change rows (JSON with ``action`` and ``columns``) -> points, and the last change position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.functions import json as J
from pointgate.functions.json import with_json_fields
from pointgate.functions.numbers import is_finite
from pointgate.functions.times import as_of_ns
from pointgate.operators import points as P
from pointgate.operators.normalize import with_path_time
from pointgate.options import PathMapping

def _column_value(name: str) -> Column:
    """VARIANT ``value`` of the first column entry with this name; null when there is none."""
    named = F.filter("__columns", lambda c: c["name"] == name)
    return F.get(named, F.lit(0))["value"]


def decode_change_rows(
    df: DataFrame, raw: str, mapping: PathMapping, as_of_ms: int | None = None
) -> DataFrame:
    """Change messages -> points.

    Metrics and time are looked up by column name first, then as JSON paths.  Blank messages and anything but
    insert, update and delete rows with a ``columns`` list are skipped; invalid JSON is rejected.
    """
    slots = [f"__m{i}" for i in range(len(mapping.field_paths))]
    paths = dict(zip(slots, mapping.field_paths))
    if mapping.timestamp_path is not None:
        paths["__ts_value"] = mapping.timestamp_path
    df = df.filter(F.trim(F.col(raw)) != "")
    df = with_json_fields(df, F.col(raw), values={"__action": "action", "__list": "columns", **paths})
    df = df.withColumns(
        {
            "__action": F.try_variant_get("__action", "$", "string"),
            "__columns": F.try_variant_get("__list", "$", "array<struct<name string, value variant>>"),
        }
    )
    by_name = {slot: J.as_double(_column_value(path)) for slot, path in paths.items() if slot in slots}
    found = {slot: F.coalesce(by_name[slot], J.as_double(F.col(slot))) for slot in slots}
    if mapping.timestamp_path is not None:
        found["__ts_value"] = F.coalesce(_column_value(mapping.timestamp_path), F.col("__ts_value"))
    df = df.withColumns(found)
    change = F.col("__columns").isNotNull() & F.col("__action").isin("I", "U", "D")
    checks: list[tuple[Column, Column | str]] = [(~F.col("__ok"), "cdc change data is not JSON")]
    for slot, path in zip(slots, mapping.field_paths):
        checks.append((F.col(slot).isNull(), f"Missing Field: {path}"))
        checks.append((~is_finite(F.col(slot)), f"Non-finite value at path {path}"))
    ts = as_of_ns(as_of_ms)
    if mapping.timestamp_path is not None:
        df, wrong = with_path_time(df, as_of_ms)
        ts = F.col("__ts")
        checks.append((F.col("__ts_value").isNull(), f"Missing Field: {mapping.timestamp_path}"))
        checks.append((wrong.isNotNull(), wrong))
    return P.with_point(
        df,
        ts,
        F.array(*slots),
        F.col(raw),
        parse_error=P.first_error(*checks),
        keep=~F.col("__ok") | F.coalesce(change, F.lit(False)),
        drop=("__ok", "__action", "__list", "__columns", *slots, "__ts_value", "__ts", "__ts_type"),
    )


def last_position(
    df: DataFrame, position: str, order: list[str], by: list[str] | None = None, restart: str | None = None
) -> DataFrame:
    """The last non-blank change position in ``order`` (per ``by``), else ``restart``, else ``0/0``."""
    filled = F.trim(F.coalesce(F.col(position), F.lit(""))) != ""
    last = F.max_by(F.when(filled, F.col(position)), F.when(filled, F.struct(*order)))
    fallback = restart if restart and restart.strip() else "0/0"
    return df.groupBy(*(by or [])).agg(F.coalesce(last, F.lit(fallback)).alias("last_position"))


def position_number(position: Column) -> Column:
    """``hi/lo`` hexadecimal position -> a number that orders like it."""
    halves = F.split(position, "/")
    part = lambda i: F.conv(F.get(halves, F.lit(i)), 16, 10).try_cast("decimal(20,0)")
    return (part(0) * F.lit(4294967296).cast("decimal(11,0)") + part(1)).cast("decimal(30,0)")
