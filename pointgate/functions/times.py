"""Record time -> nanoseconds since 1970 (BIGINT).  All text is read as UTC."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pointgate.functions.numbers import BIGINT_MAX, saturating_bigint, strict_double

# Preset format names.
PRESETS = {
    "datetime_utc": "%Y-%m-%d %H:%M:%S",
    "datetime_utc_ms": "%Y-%m-%d %H:%M:%S%.f",
}
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
LONG_MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
LONG_WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

_MACROS = {
    "%T": "%H:%M:%S", "%F": "%Y-%m-%d", "%R": "%H:%M", "%e": "%d", "%D": "%m/%d/%y", "%h": "%b", "%k": "%H",
    "%r": "%I:%M:%S %p", "%l": "%I", "%n": "\n", "%t": "\t", "%P": "%p",
}
_TWO_DIGITS = r"\s*(\d{1,2})"
_PARTS = {
    "%Y": ("year", r"\s*\+?(\d{4})"),
    "%m": ("month", _TWO_DIGITS),
    "%d": ("day", _TWO_DIGITS),
    "%H": ("hour", _TWO_DIGITS),
    "%M": ("minute", _TWO_DIGITS),
    "%S": ("second", _TWO_DIGITS),
    "%b": ("month_name", r"(?i:(" + "|".join(MONTHS) + "))"),
    "%B": ("month_name", r"(?i:(" + "|".join(LONG_MONTHS) + "))"),
    "%y": ("short_year", _TWO_DIGITS),
    "%I": ("half_hour", _TWO_DIGITS),
    "%p": ("half", r"(?i:(am|pm))"),
    "%j": ("year_day", r"\s*(\d{1,3})"),
    "%s": ("epoch", r"\s*([+-]?\d+)"),
    "%a": ("weekday", r"(?i:(" + "|".join(WEEKDAYS) + "))"),
    "%A": ("weekday", r"(?i:(" + "|".join(LONG_WEEKDAYS) + "))"),
    "%u": ("day_of_week", r"\s*([1-7])"),
    "%w": ("day_of_week_0", r"\s*([0-6])"),
    "%G": ("iso_year", r"\s*\+?(\d{4})"),
    "%g": ("short_iso_year", _TWO_DIGITS),
    "%V": ("iso_week", _TWO_DIGITS),
    "%U": ("sunday_week", _TWO_DIGITS),
    "%W": ("monday_week", _TWO_DIGITS),
    "%C": ("century", _TWO_DIGITS),
    "%.f": ("fraction", r"(?:\.(\d+))?"),
    "%f": ("nanos", r"\s*(\d{1,9})"),
    "%z": (None, r"\s*(?:Z|[+-]\d{2}:?\d{2})"),
    "%%": (None, "%"),
}


def _compile(fmt: str) -> tuple[str, dict[str, int]]:
    """strftime-style format -> (Java regex, part name -> group number)."""
    for macro, body in _MACROS.items():
        fmt = fmt.replace(macro, body)
    fmt = re.sub(r"%\.[369]f", "%.f", fmt)
    regex, groups = r"\A", {}
    for token in re.findall(r"%\.f|%.|\s+|[^%\s]", fmt):
        if token.isspace():
            regex += r"\s*"
        elif not token.startswith("%"):
            regex += re.escape(token)
        elif token in _PARTS:
            name, part = _PARTS[token]
            regex += part
            if name:
                groups[name] = len(groups) + 1
        else:
            raise ValueError(f"unsupported date-time format token {token} in {fmt!r}")
    has = set(groups)
    if "epoch" not in has:
        iso = {"iso_year", "short_iso_year"} & has and "iso_week" in has and _WEEKDAY & has
        weeks = {"sunday_week", "monday_week"} & has and _WEEKDAY & has
        missing = [] if iso or {"year", "short_year"} & has else ["year"]
        if not (iso or weeks or "year_day" in has):
            missing += [*({"day"} - has), *([] if {"month", "month_name"} & has else ["month"])]
        missing += [] if "hour" in has or {"half_hour", "half"} <= has else ["hour"]
        missing += sorted({"minute"} - has)
        if missing:
            raise ValueError(f"date-time format {fmt!r} lacks {missing}")
    return regex + r"\z", groups


def _micros_to_ns(moment: Column, extra_ns: Column | None = None) -> Column:
    whole = F.try_multiply(F.unix_micros(moment), F.lit(1000).cast("bigint"))
    return whole if extra_ns is None else F.try_add(whole, extra_ns)


def _month_number(name: Column) -> Column:
    short = F.lower(F.substring(name, 1, 3))
    number = F.lit(None).cast("string")
    for i, month in enumerate(MONTHS, 1):
        number = F.when(short == month.lower(), F.lit(str(i))).otherwise(number)
    return number


_WEEKDAY = {"weekday", "day_of_week", "day_of_week_0"}
_LESS_COMMON = {
    "short_year", "half_hour", "year_day", "epoch", "iso_year", "short_iso_year", "iso_week", "sunday_week",
    "monday_week", "century", *_WEEKDAY,
}


def _full_year(short: Column) -> Column:
    return F.when(short < 69, short + 2000).otherwise(short + 1900)


def _day_of(year: Column, month_day: str) -> Column:
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit(month_day)).try_cast("date")


def _iso_year(day: Column) -> Column:
    """The year of the week's Thursday."""
    return F.year(F.date_add(day, 3 - F.weekday(day)))


def _week_of(day: Column, first: int) -> Column:
    """Number of the week in its year; weeks begin on weekday ``first`` (Monday: 0), days before the first are in week 0."""
    return F.floor((F.dayofyear(day) + 6 - F.pmod(F.weekday(day) - first, F.lit(7))) / 7)


def _first(year: Column, weekday: int) -> Column:
    """The first such weekday of a year (Monday: 0)."""
    begin = _day_of(year, "-01-01")
    return F.date_add(begin, F.pmod(F.lit(weekday) - F.weekday(begin), F.lit(7)))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts_of(value: Column, regex: str, groups: dict[str, int]) -> Column:
    """All groups of a match as one array, found in one pass; null without a match."""
    joined = F.regexp_replace(value, regex, "\u0001".join(f"${i}" for i in groups.values()))
    return F.split(F.when(value.rlike(regex), joined), "\u0001", -1)


def _from_parts(parts: Column, groups: dict[str, int]) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` from any parts; null when they contradict each other."""
    pick = lambda name: F.get(parts, F.lit(groups[name] - 1))
    number = lambda name: pick(name).try_cast("int")
    if "epoch" in groups:
        moment = F.try_multiply(pick("epoch").try_cast("bigint"), F.lit(1_000_000).cast("bigint"))
        return F.date_format(F.timestamp_micros(moment), "yyyy-MM-dd HH:mm:ss")
    has = set(groups)
    year = number("year") if "year" in has else None
    if year is None and "short_year" in has:
        short = number("short_year")
        year = number("century") * 100 + F.when(short < 100, short) if "century" in has else _full_year(short)
    iso_year = number("iso_year") if "iso_year" in has else None
    if iso_year is None and "short_iso_year" in has:
        iso_year = _full_year(number("short_iso_year"))
    weekday = None  # Monday: 0
    if "day_of_week" in has:
        weekday = number("day_of_week") - 1
    elif "day_of_week_0" in has:
        weekday = F.pmod(number("day_of_week_0") + 6, F.lit(7))
    elif "weekday" in has:
        weekday = F.array_position(F.array(*map(F.lit, WEEKDAYS)), F.initcap(F.substring(pick("weekday"), 1, 3))) - 1
    month = _month_number(pick("month_name")) if "month_name" in has else pick("month") if "month" in has else None
    if year is not None and month is not None and "day" in has:
        day = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month, pick("day")).try_cast("date")
    elif year is not None and "year_day" in has:
        day = F.date_add(_day_of(year, "-01-01"), number("year_day") - 1)
    elif iso_year is not None and "iso_week" in has and weekday is not None:
        fourth = _day_of(iso_year, "-01-04")  # always in week 1
        shift = (number("iso_week") - 1) * 7 + weekday - F.weekday(fourth)
        day = F.date_add(fourth, shift.cast("int"))
    else:
        name, begin = ("sunday_week", 6) if "sunday_week" in has else ("monday_week", 0)
        inside = F.pmod(weekday - begin, F.lit(7))
        day = F.date_add(_first(year, begin), ((number(name) - 1) * 7 + inside).cast("int"))
    def agreeing(day: Column) -> Column:
        """The day, if every part given agrees with it."""
        told = {
            "year_day": lambda: F.dayofyear(day) == number("year_day"),
            "iso_week": lambda: F.weekofyear(day) == number("iso_week"),
            "sunday_week": lambda: _week_of(day, 6) == number("sunday_week"),
            "monday_week": lambda: _week_of(day, 0) == number("monday_week"),
            "weekday": lambda: F.lower(F.date_format(day, "EEE")) == F.lower(F.substring(pick("weekday"), 1, 3)),
            "day_of_week": lambda: F.weekday(day) + 1 == number("day_of_week"),
            "day_of_week_0": lambda: F.dayofweek(day) - 1 == number("day_of_week_0"),
            "century": lambda: F.floor(F.year(day) / 100) == number("century"),
            "short_year": lambda: F.year(day) % 100 == number("short_year"),
        }
        agrees = F.lit(True)
        for name in sorted(has & set(told)):
            agrees = agrees & told[name]()
        if year is not None:
            agrees = agrees & (F.year(day) == year)
        if iso_year is not None:
            agrees = agrees & (_iso_year(day) == iso_year)
        if month is not None:
            agrees = agrees & (F.month(day) == month.try_cast("int"))
        if "day" in has:
            agrees = agrees & (F.dayofmonth(day) == number("day"))
        return F.when(agrees, day)

    day = _once(day, agreeing)
    hour = number("hour") if "hour" in groups else number("half_hour")
    if "hour" not in groups:
        late = F.when(F.lower(pick("half")) == "pm", 12).otherwise(0)
        hour = F.when(hour.between(1, 12), hour % 12 + late)
    second = pick("second") if "second" in groups else F.lit("0")
    clock = F.concat(hour.cast("string"), F.lit(":"), pick("minute"), F.lit(":"), second)
    return F.concat(day.cast("string"), F.lit(" "), clock)


def _parts_to_ns(parts: Column, groups: dict[str, int]) -> Column:
    moment = F.concat(_from_parts(parts, groups), F.lit("+00:00")).try_cast("timestamp")
    extra = None
    if "fraction" in groups:
        extra = F.rpad(F.substring(F.get(parts, F.lit(groups["fraction"] - 1)), 1, 9), 9, "0").try_cast("bigint")
    elif "nanos" in groups:
        extra = F.get(parts, F.lit(groups["nanos"] - 1)).try_cast("bigint")
    return F.when(parts.isNotNull(), _micros_to_ns(moment, extra))


def datetime_to_ns(text: Column, fmt: str, date_override: str | None = None) -> Column:
    """Date-time text -> ns, exact to the nanosecond; null when it does not parse.  Negative before 1970."""
    value = F.trim(text)
    if fmt == "time_utc":
        if not date_override:
            raise ValueError("time_utc needs date_override (YYYY-MM-DD)")
        value = F.concat(F.lit(date_override + " "), value)
        fmt = "datetime_utc_ms"
    regex, groups = _compile(PRESETS.get(fmt, fmt))
    if _LESS_COMMON & set(groups):
        return _once(value, lambda v: _once(_parts_of(v, regex, groups), lambda parts: _parts_to_ns(parts, groups)))
    if "month_name" in groups:
        month = _month_number(F.regexp_extract(value, regex, groups["month_name"]))
        pick = lambda name: F.regexp_extract(value, regex, groups[name])
        head = F.concat(pick("year"), F.lit("-"), month, F.lit("-"), pick("day"), F.lit(" "))
        second = pick("second") if "second" in groups else F.lit("0")
        clock = F.concat_ws(":", pick("hour"), pick("minute"), second)
        canonical = F.concat(head, clock)
    else:
        second = f"${groups['second']}" if "second" in groups else "0"
        canonical = F.regexp_replace(
            value,
            regex,
            f"${groups['year']}-${groups['month']}-${groups['day']} ${groups['hour']}:${groups['minute']}:{second}",
        )
    moment = F.concat(canonical, F.lit("+00:00")).try_cast("timestamp")
    extra = None
    if "fraction" in groups:
        digits = F.regexp_extract(value, regex, groups["fraction"])
        extra = F.rpad(F.substring(digits, 1, 9), 9, "0").try_cast("bigint")
    elif "nanos" in groups:
        extra = F.regexp_extract(value, regex, groups["nanos"]).try_cast("bigint")
    return F.when(value.rlike(regex), _micros_to_ns(moment, extra))


def rfc3339_to_ns(text: Column) -> Column:
    """``2024-01-05T10:11:12.5Z`` or with a numeric offset -> ns; null when it does not parse."""
    regex = r"\A(\d{4}-\d{1,2}-\d{1,2})[Tt ](\d{1,2}:\d{1,2}:\d{1,2})(?:\.(\d+))?([Zz]|[+-]\d{2}:\d{2})\z"
    canonical = F.regexp_replace(text, regex, "$1 $2$4")
    digits = F.regexp_extract(text, regex, 3)
    extra = F.rpad(F.substring(digits, 1, 9), 9, "0").try_cast("bigint")
    return F.when(text.rlike(regex), _micros_to_ns(F.upper(canonical).try_cast("timestamp"), extra))


def number_to_ns(raw: Column, unit: str, tick_hz: float = 64.0) -> Column:
    """DOUBLE in s, ms, ns or ticks -> ns.  Null for negative, NaN and infinite input."""
    if unit == "s":
        ns = raw * F.lit(1e9)
    elif unit == "ms":
        ns = raw * F.lit(1e6)
    elif unit == "ns":
        ns = raw
    elif unit == "tick":
        ns = (raw / F.lit(float(tick_hz))) * F.lit(1e9)
    else:
        raise ValueError(f"unsupported timestamp unit: {unit}")
    usable = (raw >= 0) & ~F.isnan(raw) & (raw != F.lit(float("inf")))
    return F.when(usable, saturating_bigint(ns))


def epoch_text_to_ns(text: Column, unit: str, tick_hz: float = 64.0) -> Column:
    return number_to_ns(strict_double(text), unit, tick_hz)


def whole_ms_to_ns(ms: Column) -> Column:
    """BIGINT milliseconds -> ns; beyond the range stays at the last representable millisecond."""
    cap = F.lit(BIGINT_MAX // 1_000_000).cast("bigint")
    return F.when(ms > cap, cap).otherwise(ms) * F.lit(1_000_000).cast("bigint")


def truncated_ms_to_ns(ms: Column) -> Column:
    """DOUBLE milliseconds cut to whole ones; below zero counts as 0."""
    return whole_ms_to_ns(saturating_bigint(ms))


def native_to_ns(moment: Column) -> Column:
    """TIMESTAMP (or TIMESTAMP_NTZ read as UTC) -> ns; null beyond the range of BIGINT nanoseconds."""
    return F.try_multiply(F.unix_micros(moment.cast("timestamp")), F.lit(1000).cast("bigint"))


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def event_time(timestamp_ns: Column) -> Column:
    """ns -> TIMESTAMP (microseconds), for watermarks and partitions."""
    return F.timestamp_micros(_div(timestamp_ns, 1000))


def to_ms(timestamp_ns: Column) -> Column:
    """ns -> whole milliseconds."""
    return _div(timestamp_ns, 1_000_000)


def utc_day(timestamp_ns: Column) -> Column:
    """ns -> the UTC day."""
    return F.date_from_unix_date(_div(timestamp_ns, 86_400_000_000_000).cast("int"))


def now_ns() -> Column:
    """One clock reading per query, at millisecond resolution."""
    return F.unix_millis(F.current_timestamp()) * F.lit(1_000_000).cast("bigint")


def as_of_ns(as_of_ms: int | None) -> Column:
    return now_ns() if as_of_ms is None else F.lit(as_of_ms * 1_000_000).cast("bigint")


def as_of_ms_col(as_of_ms: int | None) -> Column:
    return F.unix_millis(F.current_timestamp()) if as_of_ms is None else F.lit(as_of_ms).cast("bigint")
