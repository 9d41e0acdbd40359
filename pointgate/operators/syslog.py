"""Syslog lines -> points that mark an event: every metric is 1.0, the time is the header's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.functions import times
from pointgate.operators import points as P

_HEADER_5424 = r"\A<[^>]*>\s*\S+\s+(\S+)"
_HEADER_3164 = (
    r"\A<[^>]*>\s*(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\+?(\d+)\s+(\d{1,2}:\d{1,2}:\d{1,2})(?=\s|\z)"
)


def header_time_5424(line: Column) -> Column:
    """Second token after the priority, as RFC 3339; null when absent or not a time."""
    return times.rfc3339_to_ns(F.regexp_extract(line, _HEADER_5424, 1))


def header_time_3164(line: Column, year: Column) -> Column:
    """``Mon D H:M:S`` after the priority, in the given year."""
    pick = lambda group: F.regexp_extract(line, _HEADER_3164, group)
    day = F.regexp_replace(pick(2), r"\A0+(?=\d)", "")
    text = F.concat_ws(" ", year.cast("string"), pick(1), day, pick(3))
    return times.datetime_to_ns(text, "%Y %b %d %H:%M:%S")


def decode_syslog(
    df: DataFrame,
    raw: str,
    form: str,
    field_count: int = 1,
    year: int | None = None,
    as_of_ms: int | None = None,
) -> DataFrame:
    """Lines in ``rfc5424`` or ``rfc3164`` form -> points.

    Line ends are trimmed, empty lines skipped, an unreadable header time means now.  The 3164 form has no
    year; it is that of the run unless given.
    """
    form = form.lower()
    now = times.as_of_ns(as_of_ms)
    line = F.regexp_replace(F.col(raw), r"[\r\n]+\z", "")
    df = df.withColumn("__line", line)
    if form == "rfc5424":
        stated = header_time_5424(F.col("__line"))
    elif form == "rfc3164":
        which = F.year(times.utc_day(now)) if year is None else F.lit(year)
        stated = header_time_3164(F.col("__line"), which)
    else:
        stated = F.lit(None).cast("bigint")
    metrics = F.array(*[F.lit(1.0)] * max(field_count, 1))
    df = df.withColumn("__stated", stated)
    return P.with_point(
        df,
        F.coalesce("__stated", now),
        metrics,
        F.col("__line"),
        keep=F.col("__line") != "",
        drop=("__line", "__stated"),
    )
