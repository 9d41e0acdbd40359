"""Line dedup: lines that many sites share are removed from all documents but the first that holds them.

A line's key is the hash of its text without the spaces around it.  Per key the sites (``source``) are counted with
HyperLogLog sketches, built per task and merged by aggregation.  Keys whose estimate lies clearly above or below the
threshold are decided by it; those near the threshold are counted exactly.  A key at or above the threshold is
boilerplate: its lines go, except the very first one (smallest ``doc_id``, then position), so no text is lost.

Every line counts, however short, unless it is blank (nothing but spaces); blank lines are never removed.  A null
site counts as one site of its own, and so does a missing ``source`` column; a null text has no lines and stays null.
Of rows that repeat a ``doc_id`` the one with the smallest text hash comes first; equal rows are treated alike.  Row
count, ids and all other columns are kept, whatever their names.

DataFrame functions only.  Lines travel as hashes; a hot line is one row per task after partial aggregation, and only
boilerplate positions travel back to the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.llm.text import materialise, prepare


@dataclass(frozen=True)
class LineOptions:
    min_sites: int = 5
    sketch_bits: int = 11
    margin: float = 0.25


_NULL_ID = -(2**63)
ROW = ["row_id", "row_hash"]
KEY = ["line_key", "line_key2"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def row_key(docs: DataFrame) -> list[Column]:
    """Rows are told apart by id and text hash."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("row_id"),
        F.xxhash64(F.col("text")).alias("row_hash"),
    ]


def keyed_lines(docs: DataFrame) -> DataFrame:
    """Row key, place, line key (96 bits) and site of every line that is not blank."""
    site = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    lines = docs.select(
        *row_key(docs), site.alias("site"), F.posexplode(lines_of(F.col("text"))).alias("place", "line")
    )
    line = F.trim(F.col("line"))
    return lines.where(line != "").select(
        *ROW, "place", "site", F.xxhash64(line).alias(KEY[0]), F.hash(line).alias(KEY[1])
    )


def boilerplate_keys(lines: DataFrame, options: LineOptions) -> DataFrame:
    """Line keys on at least ``min_sites`` sites, with their number of sites and the first line that holds each."""
    low, high = options.min_sites * (1 - options.margin), options.min_sites * (1 + options.margin)
    decided = materialise(
        lines.groupBy(*KEY)
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", options.sketch_bits)).alias("estimate"),
            F.min(F.struct(*ROW, "place")).alias("first"),
        )
        .where(F.col("estimate") >= low),
        "line-sites",
    )
    near = decided.where(F.col("estimate") < high).select(*KEY)
    exact = (
        lines.join(near, KEY, "left_semi").select(*KEY, "site").distinct()
        .groupBy(*KEY).agg(F.count(F.lit(1)).alias("exact"))
    )
    return (
        decided.join(exact, KEY, "left")
        .withColumn("sites", F.coalesce("exact", "estimate"))
        .where(F.col("sites") >= options.min_sites)
        .select(*KEY, "sites", "first")
    )


def without_places(lines: Column, gone: Column) -> Column:
    """The lines but those at the places ``gone``: the runs between them, so the work grows with the lines alone."""
    places = F.sort_array(gone)

    def kept(every: Column) -> Column:
        before = F.concat(F.array(F.lit(-1)), places)
        after = F.concat(places, F.array(F.size(every)))
        return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(every, a + 2, b - a - 1)))

    return F.transform(F.array(lines), kept)[0]  # the text is cut into lines once


def removed_places(docs: DataFrame, options: LineOptions) -> DataFrame:
    """Per row key, the places of the lines to remove."""
    lines = keyed_lines(docs)
    # Written, so that both sides of the join are plain exchanges and the rows of a hot line can be split.
    keys = materialise(boilerplate_keys(lines, options), "boilerplate")
    gone = lines.join(keys, KEY).where(F.struct(*ROW, "place") != F.col("first"))
    return gone.groupBy(*ROW).agg(F.collect_set("place").alias("gone"))


def without_boilerplate(docs: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """``docs`` with boilerplate lines cut out of the texts; every row and every other column stays."""
    done = edited(docs, options)
    return done.select(
        *[F.col("new_text").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    )


def edited(docs: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """The input row as struct ``row``, its text without boilerplate lines, and how many lines it had and lost."""
    prepare(docs.sparkSession)
    gone = removed_places(docs, options)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(docs))
    text = F.col("row")["text"]
    left = without_places(lines_of(text), F.col("gone"))
    return rows.join(gone, ROW, "left").select(
        "row",
        F.when(F.col("gone").isNull(), text).otherwise(F.array_join(left, "\n")).alias("new_text"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines_of(text))).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long").alias("n_removed"),
    )
