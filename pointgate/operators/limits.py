"""Run limits: a number of accepted records, a number of pages."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointgate.operators import points as P
from pointgate.session import staged


def _literal(value: object, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def _nth(keys: DataFrame, order: Sequence[str], n: int, part_rows: int, top_rows: int) -> Row | None:
    """Order values of the n-th row (1-based), or null when there are fewer rows.

    Up to ``top_rows`` rows are found as a top-k: each task keeps its best n, so one task gets n per partition at most.
    Beyond that the ranges of a range shuffle are counted and only the rows of the range the n-th one falls in are
    numbered.
    """
    if n <= top_rows:
        best = keys.orderBy(*order).limit(n)
        found = best.agg(F.count(F.lit(1)).alias("rows"), F.max(F.struct(*order)).alias("last")).first()
        return found["last"] if found["rows"] == n else None
    total = keys.count()
    if total < n:
        return None
    ranged = staged(
        keys.repartitionByRange(max(1, math.ceil(total / part_rows)), *order).withColumn("__part", F.spark_partition_id()),
        "limit",
    )
    before = 0
    for part, rows in sorted(ranged.groupBy("__part").count().collect()):  # one row per range
        if before + rows >= n:
            place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
            one = ranged.filter(F.col("__part") == part).withColumn("__place", place)
            return one.filter(F.col("__place") == n - before).select(*order).first()
        before += rows
    return None


def limit_accepted(
    df: DataFrame,
    max_records: int | None,
    order: Sequence[str],
    part_rows: int = 5_000_000,
    top_rows: int = 100_000,
) -> DataFrame:
    """All records up to and including the ``max_records``-th accepted one, rejected ones among them kept.

    ``order`` must order the records totally (no nulls).  The frame is read several times, so stage it
    (``session.staged``) where it is more than a scan, as ``plans.run`` does.
    """
    if max_records is None:
        return df
    if max_records <= 0:
        return df.limit(0)
    accepted = df.filter(F.col("status") == P.ACCEPTED).select(*order)
    cut = _nth(accepted, list(order), max_records, part_rows, top_rows)
    if cut is None:
        return df
    edge = {name: _literal(cut[name], df.schema[name].dataType) for name in order}
    # Comparing the leading column alone as well lets the scan skip files and row groups.
    return df.filter(
        (F.col(order[0]) <= edge[order[0]])
        & (F.struct(*order) <= F.struct(*[value.alias(name) for name, value in edge.items()]))
    )


def limit_pages(df: DataFrame, max_pages: int | None, page: str = "page_no") -> DataFrame:
    """Pages below the cap (pages count from 0)."""
    return df if max_pages is None else df.filter(F.col(page) < max_pages)
