"""Inputs of the registered queries, derived by Spark from the given tables.

Every row of a table becomes a record; some get a defect by their key, none is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.functions import times
from pointgate.functions.json import with_json_fields
from pointgate.functions.numbers import strict_double
from pointgate.operators import normalize as N
from pointgate.options import PointMapping, TimeSpec
from pointgate.session import configure, scratch_path

AS_OF_MS = 1_705_708_800_000  # 2024-01-20 00:00 UTC
DAY_MS = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as points: metric 0 is value, metric 1 is props.k, feed is event_type."""
    events = table(spark, sf_dir, "events")
    events = with_json_fields(events, F.col("props"), {"k": "k"}).withColumn("k", strict_double(F.col("k")))
    mapping = PointMapping({"value": 0, "k": 1}, 2, TimeSpec(field="ts"))
    points = N.normalize_columns(events, mapping, F.col("props"), AS_OF_MS)
    return points.withColumn("feed", F.col("event_type")).drop("value", "props", "k", "__ok")


def ms(moment: str) -> Column:
    """Whole milliseconds of a time column."""
    return times.to_ms(times.native_to_ns(F.col(moment)))


def text(*parts: str | Column) -> Column:
    """Concatenate literals (str) and columns printed as text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def pick(number: Column, *choices: Column) -> Column:
    """choices[number % len(choices)]."""
    chain = None
    kind = F.pmod(number, F.lit(len(choices)))
    for i, choice in enumerate(choices[:-1]):
        chain = F.when(kind == i, choice) if chain is None else chain.when(kind == i, choice)
    return chain.otherwise(choices[-1])


def write_lines(df: DataFrame, label: str, header: str | None = None, extension: str = "csv") -> str:
    """Write a one-column frame as text files, each starting with ``header`` when given; returns the folder."""
    root = scratch_path(df.sparkSession, label)
    if header is None:
        df.write.text(root)
        return root
    # The CSV writer with unused separators writes the text as it is and repeats the header in every file.
    writer = df.toDF(header).write.option("sep", "\u0001").option("quote", "\u0002").option("escape", "\u0002")
    writer = writer.option("emptyValue", "").option("header", True).option("extension", extension)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root)
    return root
