"""Records -> points: CSV cells, JSON documents, typed columns, typed points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointgate.functions import json as J
from pointgate.functions import times
from pointgate.functions.json import with_json_fields
from pointgate.functions.numbers import is_finite, strict_double
from pointgate.operators import points as P
from pointgate.options import PathMapping, PointMapping, TimeSpec

_TS = "__ts"
_TS_VALUE = "__ts_value"
_TS_TYPE = "__ts_type"
_PATH_TIME_FORMAT = "%Y-%m-%d %H:%M:%S%.f"


def _text_time(text: Column, spec: TimeSpec) -> Column:
    if spec.format is not None:
        return times.datetime_to_ns(text, spec.format, spec.date_override)
    return times.epoch_text_to_ns(text, spec.unit, spec.tick_hz)


def _time_error(text: Column, ns: Column, spec: TimeSpec) -> tuple[Column, Column]:
    """A time that did not parse, or lies before 1970."""
    # The texts, which consumers of the dead letter match.
    if spec.format is None:
        return ns.isNull(), F.concat(F.lit("invalid timestamp value: "), text)
    reason = F.when(ns < 0, F.concat(F.lit("datetime before Unix epoch: "), text)).otherwise(
        F.concat(F.lit("Failed parsing datetime '"), text, F.lit(f"' with format '{spec.format}'"))
    )
    return ns.isNull() | (ns < 0), reason


def csv_record_text(cells: list[str]) -> Column:
    """Raw form of a CSV record: its cells joined by ``|``."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in cells])


def normalize_csv(
    df: DataFrame,
    mapping: PointMapping,
    cells: list[str],
    strict: bool = True,
    as_of_ms: int | None = None,
    raw: Column | None = None,
) -> DataFrame:
    """String cells -> points.

    ``strict``: every metric must be mapped, else the record is rejected.  Otherwise unmapped metrics are 0.0.
    A frame that already has ``error_code``/``parse_error`` (unreadable records) keeps those.
    """
    spec = mapping.time
    cell = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(""))
    checks: list[tuple[Column, Column | str]] = []
    if spec.field is None:
        ts = times.as_of_ns(as_of_ms)
        df = df.withColumn("__ts", ts)
    elif spec.field in cells:
        df = df.withColumn("__ts", _text_time(cell(spec.field), spec))
        checks.append(_time_error(cell(spec.field), F.col("__ts"), spec))
    else:
        df = df.withColumn("__ts", F.lit(None).cast("bigint"))
        checks.append((F.lit(True), f"missing timestamp field: {spec.field}"))
    slots: dict[int, Column] = {}
    parsed = {}
    for name, index in mapping.by_index():
        if name not in cells:
            checks.append((F.lit(True), f"Missing Field: {name}"))
            continue
        parsed[f"__m{index}"] = strict_double(cell(name))
        slots[index] = F.col(f"__m{index}")
        text = (  # fixed values
            F.concat(F.lit("Type Error: Could not parse '"), cell(name), F.lit("' as f64"))
            if strict
            else F.lit(f"invalid numeric value for {name}")
        )
        checks.append((slots[index].isNull(), text))
    if strict and len(mapping.field_map) != mapping.field_count:
        found = f"Missing Field: Expected {mapping.field_count}, got {len(mapping.field_map)}"
        checks.append((F.lit(True), found))
    df = df.withColumns(parsed) if parsed else df
    metrics = F.array(*[slots.get(i, F.lit(0.0)) for i in range(mapping.field_count)])
    error = P.first_error(*checks)
    code = F.when(error.isNotNull(), F.lit(P.PARSE_ERROR))
    if "error_code" in df.columns:
        error = F.when(F.col("error_code").isNotNull(), F.col("parse_error")).otherwise(error)
        code = F.coalesce(F.col("error_code"), code)
    return P.with_point(
        df,
        F.col("__ts"),
        metrics,
        csv_record_text(cells) if raw is None else raw,
        parse_error=error,
        error_code=code,
        drop=("__ts", *parsed),
    )


def normalize_json_map(
    df: DataFrame, raw: str, mapping: PointMapping, as_of_ms: int | None = None, trim: bool = False
) -> DataFrame:
    """JSON text -> points by ``field_map`` (names are dot paths).

    A missing time means now.  Unmapped metrics are 0.0.  A frame with ``error_code`` set keeps those errors.
    """
    spec = mapping.time
    source = F.trim(F.col(raw)) if trim else F.col(raw)
    texts = {f"__m{index}": name for name, index in mapping.by_index()}
    values = {} if spec.field is None else {_TS_VALUE: spec.field}
    df = with_json_fields(df, source, texts, values)
    staged: dict[str, Column] = {slot: strict_double(F.col(slot)) for slot in texts}
    if spec.field is not None:
        moment = F.try_variant_get(_TS_VALUE, "$", "string")
        if spec.format is not None:
            staged["__ts_text"] = F.when(J.is_string(J.value_type(F.col(_TS_VALUE))), moment)
        staged["__ts_number"] = strict_double(moment)
    df = df.withColumns(staged)
    checks: list[tuple[Column, Column | str]] = [(~F.col("__ok"), "invalid JSON")]
    now = times.as_of_ns(as_of_ms)
    ts = now
    if spec.field is not None:
        number = F.col("__ts_number")
        numeric = times.number_to_ns(number, spec.unit, spec.tick_hz)
        ts = F.when(number.isNotNull(), numeric).otherwise(now)
        bad_number = (number.isNotNull() & numeric.isNull(), F.lit("invalid timestamp value"))
        if spec.format is not None:
            words = F.col("__ts_text")
            from_text = times.datetime_to_ns(words, spec.format, spec.date_override)
            ts = F.when(words.isNotNull(), from_text).otherwise(ts)
            wrong, reason = _time_error(words, from_text, spec)
            checks.append((words.isNotNull() & wrong, reason))
            bad_number = (words.isNull() & bad_number[0], bad_number[1])
        checks.append(bad_number)
    for name, index in mapping.by_index():
        value = F.col(f"__m{index}")
        checks.append((value.isNull(), f"Missing Field: {name}"))
        checks.append((~is_finite(value), f"Non-finite value at {name}"))
    mapped = set(mapping.field_map.values())
    metrics = F.array(*[F.col(f"__m{i}") if i in mapped else F.lit(0.0) for i in range(mapping.field_count)])
    error = P.first_error(*checks)
    code = F.when(error.isNotNull(), F.lit(P.PARSE_ERROR))
    if "error_code" in df.columns:
        error = F.when(F.col("error_code").isNotNull(), F.col("parse_error")).otherwise(error)
        code = F.coalesce(F.col("error_code"), code)
    made = ("__ok", _TS_VALUE, *staged)
    return P.with_point(df, ts, metrics, F.col(raw), parse_error=error, error_code=code, drop=made)


def path_time(value: str, type_name: str, as_of_ms: int | None) -> tuple[Column, Column]:
    """Time of the path projections, from a VARIANT column and its type column -> (ns, error text).

    A number is whole milliseconds (cut, never below 0), a string is date-time text, anything else means now.
    """
    kind = F.col(type_name)
    words = F.try_variant_get(value, "$", "string")
    from_text = times.datetime_to_ns(words, _PATH_TIME_FORMAT)
    ts = (
        F.when(J.is_number(kind), times.truncated_ms_to_ns(F.try_variant_get(value, "$", "double")))
        .when(J.is_string(kind), from_text)
        .otherwise(times.as_of_ns(as_of_ms))
    )
    wrong, reason = _time_error(words, F.col(_TS), TimeSpec(format=_PATH_TIME_FORMAT))
    return ts, F.when(J.is_string(kind) & wrong, reason)


def with_path_time(df: DataFrame, as_of_ms: int | None) -> tuple[DataFrame, Column]:
    """Stage the time of column ``__ts_value``; returns the frame and the error text."""
    df = df.withColumn(_TS_TYPE, J.value_type(F.col(_TS_VALUE)))
    ts, wrong = path_time(_TS_VALUE, _TS_TYPE, as_of_ms)
    return df.withColumn(_TS, ts), wrong


def _path_fields(
    df: DataFrame, raw: str, mapping: PathMapping, index_only: bool = False
) -> tuple[DataFrame, list[str]]:
    """Stage metrics (as numbers), the time value and ``__ok``; returns the frame and the metric columns."""
    texts = {f"__m{i}": path for i, path in enumerate(mapping.field_paths)}
    values = {} if mapping.timestamp_path is None else {_TS_VALUE: mapping.timestamp_path}
    df = with_json_fields(df, F.col(raw), texts, values, index_only=index_only)
    return df.withColumns({slot: strict_double(F.col(slot)) for slot in texts}), list(texts)


def normalize_json_paths(
    df: DataFrame,
    raw: str,
    mapping: PathMapping,
    as_of_ms: int | None = None,
    error_before: Column | None = None,
) -> DataFrame:
    """JSON text -> points by ordered paths (pages, message buses, datagrams).

    Missing and non-finite metrics and a missing time path are errors.  ``error_before`` is the text of an
    error found earlier (e.g. invalid UTF-8).
    """
    df, slots = _path_fields(df, raw, mapping)
    checks: list[tuple[Column, Column | str]] = []
    if error_before is not None:
        checks.append((error_before.isNotNull(), error_before))
    checks.append((~F.col("__ok"), "invalid JSON"))
    for slot, path in zip(slots, mapping.field_paths):
        checks.append((F.col(slot).isNull(), f"Missing Field: {path}"))
        checks.append((~is_finite(F.col(slot)), f"Non-finite value at path {path}"))
    ts = times.as_of_ns(as_of_ms)
    if mapping.timestamp_path is not None:
        df, wrong = with_path_time(df, as_of_ms)
        ts = F.col(_TS)
        checks.append((F.col(_TS_VALUE).isNull(), f"Missing Field: {mapping.timestamp_path}"))
        checks.append((wrong.isNotNull(), wrong))
    return P.with_point(
        df,
        ts,
        F.array(*slots),
        F.col(raw),
        parse_error=P.first_error(*checks),
        drop=("__ok", *slots, _TS_VALUE, _TS, _TS_TYPE),
    )


def normalize_custom_feed(
    df: DataFrame, raw: str, mapping: PathMapping, as_of_ms: int | None = None
) -> DataFrame:
    """JSON text -> points for a caller-defined feed.

    A record that misses a path is dropped without notice, invalid JSON is rejected.  Numeric path parts are
    array positions only.  The time is a number or numeric string in milliseconds.
    """
    df, slots = _path_fields(df, raw, mapping, index_only=True)
    needed = [F.col(s).isNotNull() for s in slots]
    ts = times.as_of_ns(as_of_ms)
    if mapping.timestamp_path is not None:
        df = df.withColumn("__ts_ms", strict_double(F.try_variant_get(_TS_VALUE, "$", "string")))
        needed.append(F.col("__ts_ms").isNotNull())
        ms = F.when(F.isnan("__ts_ms"), F.lit(0.0)).otherwise(F.col("__ts_ms"))
        ts = times.truncated_ms_to_ns(ms)
    complete = F.lit(True)
    for have in needed:
        complete = complete & have
    return P.with_point(
        df,
        ts,
        F.array(*slots),
        F.col(raw),
        parse_error=F.when(~F.col("__ok"), F.lit("invalid JSON")),
        keep=~F.col("__ok") | complete,
        drop=("__ok", *slots, _TS_VALUE, "__ts_ms"),
    )


_NUMERIC = (
    T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType,
)


def normalize_columns(
    df: DataFrame, mapping: PointMapping, raw: Column, as_of_ms: int | None = None
) -> DataFrame:
    """Typed columns -> points.  Only the mapped columns are read from the source.

    A missing column or one that is no number stops the query when it is built; a null cell or bad time text
    rejects its record.
    """
    if len(mapping.field_map) != mapping.field_count:
        raise ValueError(f"field_map size {len(mapping.field_map)} does not match field_count {mapping.field_count}")
    types = {f.name: f.dataType for f in df.schema.fields}
    slots: list[Column] = [F.lit(0.0)] * mapping.field_count
    checks: list[tuple[Column, Column | str]] = []
    for name, index in mapping.by_index():
        if name not in types:
            raise ValueError(f"missing column: {name}")
        if not isinstance(types[name], _NUMERIC):
            raise TypeError(f"unsupported metric type of {name}: {types[name].simpleString()}")
        slots[index] = F.col(f"`{name}`").cast("double")
        checks.append((F.col(f"`{name}`").isNull(), f"Missing Field: {name}"))
    spec = mapping.time
    ts = times.as_of_ns(as_of_ms)
    if spec.field in types:
        moment, kind = F.col(f"`{spec.field}`"), types[spec.field]
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            ts = times.native_to_ns(moment)
            checks.append((moment.isNull(), f"Missing Field: {spec.field}"))
            checks.append((ts.isNull(), f"timestamp out of range at {spec.field}"))
            checks.append((ts < 0, f"datetime before Unix epoch at {spec.field}"))  # fixed value
        elif spec.format is not None:
            words = moment.cast("string")
            ts = times.datetime_to_ns(words, spec.format, spec.date_override)
            checks.append((words.isNull(), f"Missing Field: {spec.field}"))
            checks.append(_time_error(words, ts, spec))
        elif isinstance(kind, _NUMERIC):
            ts = times.number_to_ns(moment.cast("double"), spec.unit, spec.tick_hz)
            checks.append((ts.isNull(), f"invalid timestamp value at {spec.field}"))
    return P.with_point(df, ts, F.array(*slots), raw, parse_error=P.first_error(*checks))


def normalize_typed_points(
    df: DataFrame, timestamp: str = "timestamp_ns", metrics: str = "metrics", as_of_ms: int | None = None
) -> DataFrame:
    """``(timestamp_ns BIGINT, metrics ARRAY<DOUBLE>)`` -> points.

    A zero time means now, an empty list of metrics is skipped, a negative time is rejected.
    """
    moment = F.col(timestamp)
    ts = F.when(moment == 0, times.as_of_ns(as_of_ms)).otherwise(moment)
    raw = F.concat(
        F.lit("timestamp_ns="), ts.cast("string"), F.lit(" metrics="), F.col(metrics).cast("string")
    )
    df = df.filter(F.size(metrics) > 0).withColumns({"__ts": ts, "__raw": raw, "__metrics": F.col(metrics)})
    negative = F.coalesce(F.col("__ts") < 0, F.lit(True))
    return P.with_point(
        df,
        F.col("__ts"),
        F.col("__metrics"),
        F.col("__raw"),
        parse_error=F.when(negative, F.lit("timestamp out of range")),
        error_code=F.when(negative, F.lit(P.BAD_TIMESTAMP)),
        drop=("__ts", "__raw", "__metrics"),
    )
