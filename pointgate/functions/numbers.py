"""Number text: strict parsing, hexadecimal, and byte-stable rendering."""

from __future__ import annotations

import math

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

BIGINT_MAX = 9223372036854775807

# The accepted spellings of a decimal number, NaN (sign ignored) and infinity.
NUMBER_TEXT = (
    r"(?i)\A(?:[+-](?=nan\z))?"
    r"([+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|[+-]?inf(?:inity)?)\z"
)


def strict_double(text: Column) -> Column:
    """Text -> DOUBLE without the leniency of CAST: no spaces, type suffixes or hex floats.  Else null.

    The text is used once, so an expensive one is not computed twice.
    """
    return F.regexp_extract(text, NUMBER_TEXT, 1).try_cast("double")


def is_finite(value: Column) -> Column:
    """False for NaN and both infinities; null stays null."""
    return ~(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))))


def positive(value: Column) -> Column:
    """value > 0 with NaN counted as not positive (Spark orders NaN above every number)."""
    return (value > 0) & ~F.isnan(value)


def saturating_bigint(value: Column) -> Column:
    """Truncate a DOUBLE to BIGINT: below zero gives 0, beyond the range gives the largest BIGINT."""
    return (
        F.when(value >= F.lit(float(BIGINT_MAX)), F.lit(BIGINT_MAX))
        .when(value <= 0, F.lit(0).cast("bigint"))
        .otherwise(value.try_cast("bigint"))
    )


def hex_to_decimal_text(text: Column) -> Column:
    """``0x...`` text that fits 64 bits -> its decimal digits as text, else null."""
    digits = F.regexp_extract(text, r"\A(?:0x)*\+?0*([0-9a-fA-F]{1,16})\z", 1)
    return F.conv(digits, 16, 10)


def _plain(text: str) -> str:
    """Spell out the exponent of a shortest round-trip number."""
    mantissa, _, exponent = text.partition("e")
    sign = "-" if mantissa.startswith("-") else ""
    whole, _, fraction = mantissa.lstrip("-").partition(".")
    fraction = "" if fraction == "0" else fraction
    shift = int(exponent or 0)
    digits, point = whole + fraction, len(whole) + shift
    if point <= 0:
        return f"{sign}0.{'0' * -point}{digits}"
    if point >= len(digits):
        return f"{sign}{digits}{'0' * (point - len(digits))}"
    return f"{sign}{digits[:point]}.{digits[point:]}"


def csv_text(value: float) -> str:
    """Shortest digits, never an exponent, whole numbers without a fraction."""
    if value != value:
        return "NaN"
    if value in (float("inf"), float("-inf")):
        return "inf" if value > 0 else "-inf"
    return _plain(repr(value))


def json_text(value: float) -> str:
    """Shortest digits, plain for 1e-5 <= |x| < 1e16 (with ``.0`` for whole numbers), else ``1e16`` style."""
    size = abs(value)
    if size == 0.0 or 1e-5 <= size < 1e16:
        plain = _plain(repr(value))
        return plain if "." in plain else plain + ".0"
    mantissa, _, exponent = repr(value).partition("e")
    if not exponent:
        return mantissa
    mantissa = mantissa[:-2] if mantissa.endswith(".0") else mantissa
    return f"{mantissa}e{int(exponent)}"


def _replaced(text: pa.Array, values: pa.Array, rare: pa.Array, spell) -> pa.Array:
    """``text`` with the few ``rare`` elements spelled one by one."""
    rare = pc.fill_null(rare, False)
    if not pc.any(rare).as_py():
        return text
    few = pa.array([spell(v) for v in values.filter(rare).to_pylist()], pa.string())
    return pc.replace_with_mask(text, rare, few)


@arrow_udf(T.StringType())
def csv_number(values: pa.Array) -> pa.Array:
    """DOUBLE -> text of the CSV sink."""
    # Arrow prints the shortest digits; only exponents, NaN and infinities are spelled differently here.
    text = values.cast(pa.string())
    return _replaced(text, values, pc.match_substring_regex(text, "[en]"), csv_text)


@arrow_udf(T.StringType())
def json_number(values: pa.Array) -> pa.Array:
    """Finite DOUBLE -> text of the byte-stable JSON sink; null for NaN and infinities."""
    text = values.cast(pa.string())
    whole = pc.invert(pc.match_substring(text, "."))
    dotted = pc.if_else(whole, pc.binary_join_element_wise(text, ".0", ""), text)
    small = pc.and_(pc.less(pc.abs(values), 1e-5), pc.not_equal(values, 0.0))
    rare = pc.or_(pc.match_substring_regex(text, "[en]"), small)
    return _replaced(dotted, values, rare, lambda v: json_text(v) if math.isfinite(v) else None)
