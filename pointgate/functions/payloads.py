"""Shaping of raw payloads for the dead letter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUNCATED = " (truncated)"


def sha256_hex(raw: Column) -> Column:
    return F.sha2(raw.cast("binary"), 256)


def lossy_text(data: Column) -> Column:
    """BINARY -> text with every invalid UTF-8 sequence replaced."""
    return F.make_valid_utf8(data.cast("string"))


def first_bytes(raw: Column, count: int) -> Column:
    return lossy_text(F.substring(raw.cast("binary"), 1, count))


def truncate_bytes(raw: Column, max_bytes: int = 512) -> Column:
    """Text over ``max_bytes`` bytes is cut there and marked; shorter text is kept."""
    return F.when(
        F.octet_length(raw) > max_bytes, F.concat(first_bytes(raw, max_bytes), F.lit(TRUNCATED))
    ).otherwise(raw)


def oversize_preview(raw: Column, cap: int, hash_raw: bool, preview: int = 512) -> Column:
    """Raw text of a line over ``cap`` bytes: a hash of the kept bytes, or a marked preview of them."""
    kept = F.substring(raw.cast("binary"), 1, cap)
    if hash_raw:
        return F.sha2(kept, 256)
    return F.concat(first_bytes(raw, preview), F.lit(TRUNCATED))
