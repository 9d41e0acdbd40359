"""Labelled documents for fitting classifiers: all of them, or a bounded sample."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.llm.text import fold, prepare


def _usable(labels: DataFrame, label: str, modulus: int, remainder: int) -> DataFrame:
    """doc_id and label (0 or 1), without the held-out remainder, null ids and ids with contradicting labels."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("__label"))
        .where(F.col("__label").isin(0, 1) & (fold(F.col("doc_id"), modulus) != remainder))
        .groupBy("doc_id")
        .agg(F.min("__label").alias("__label"), F.max("__label").alias("__most"))
        .where("__label = __most")
        .drop("__most")
    )


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, part_rows: int, max_parts: int
) -> DataFrame:
    """doc_id, text, lang, label and part of every row that ``labelled_sample`` may choose from; one row per id.

    Parts follow a hash of the id; each lies in a partition of its own and is in order of the id.
    """
    prepare(docs.sparkSession)
    chosen = _usable(labels, label, modulus, remainder)
    parts = min(max_parts, max(1, math.ceil(chosen.count() / part_rows)))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(F.length("text").alias("chars"), F.col("text").cast("string").alias("text"), lang.alias("lang")).alias("row"),
        F.lit(None).cast("int").alias("label"),
    ).where((fold(F.col("doc_id"), modulus) != remainder) & F.col("text").isNotNull())
    none = F.lit(None).cast(texts.schema["row"].dataType).alias("row")
    # one shuffle of exactly that many partitions; a join would choose their number itself
    both = texts.unionByName(chosen.select("doc_id", none, F.col("__label").alias("label")))
    return (
        both.repartition(parts, "doc_id")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.min("row").alias("row"))
        .where("label is not null and row is not null")
        .sortWithinPartitions("doc_id")
        .select("doc_id", "row.text", "row.lang", "label", F.spark_partition_id().alias("part"))
    )


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    modulus: int = 5,
    remainder: int = 0,
    max_rows: int = 10_000,
    max_chars: int = 30_000_000,
) -> pd.DataFrame:
    """Whole texts with label 0 or 1, at most ``max_rows`` rows and ``max_chars`` code points, on the driver.

    Rows come in the order of a hash of their id, so the sample does not depend on partitions.  Ids of the held-out
    remainder, null ids, other label values and ids with contradicting labels are left out; of an id with several
    texts the shortest counts.  The two bounds are what the driver may hold; texts that do not fit are passed over,
    never cut.  If that leaves out a label that exists, or nearly all rows, each label is searched by itself for half
    of the bounds, by hash and then the shortest first; if this fails too, a ValueError says so.
    Columns: doc_id, text, lang, label.
    """
    spark = docs.sparkSession
    prepare(spark)
    chosen = _usable(labels, label, modulus, remainder)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang")
    ).where("text is not null")
    sizes = (
        texts.select("doc_id", F.length("text").alias("__chars"))
        .join(chosen, "doc_id")
        .groupBy("doc_id", "__label")
        .agg(F.min("__chars").alias("__chars"))
    )
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    taken = first_that_fit(sizes, by_hash, max_rows, max_chars)
    if lacks(taken):
        usable = {r["__label"]: r["count"] for r in sizes.groupBy("__label").count().collect()}
        for order in (by_hash, [F.col("__chars"), *by_hash]):
            if not lacks(taken, usable):
                break
            parts = [
                first_that_fit(sizes.where(F.col("__label") == k), order, max_rows // 2, max_chars // 2) for k in (0, 1)
            ]
            taken = pd.concat(parts, ignore_index=True)
        if lacks(taken, usable):
            raise ValueError(
                f"of {usable} usable texts by {label}, {len(taken)} fit into {max_rows} rows and {max_chars} code points"
            )
    if taken.empty:
        return pd.DataFrame({"doc_id": [], "text": [], "lang": [], "label": []})
    ids = spark.createDataFrame(taken.astype({"doc_id": "int64", "__label": "int32", "__chars": "int32"}))
    got = (
        texts.withColumn("__chars", F.length("text"))
        .join(F.broadcast(ids), ["doc_id", "__chars"])
        .groupBy("doc_id", F.col("__label").alias("label"))
        .agg(F.min(F.struct("text", "lang")).alias("row"))
        .select("doc_id", "row.text", "row.lang", "label")
        .toPandas()
    )
    return got.sort_values("doc_id").reset_index(drop=True)


#: Fewer rows than this are too few to fit on when there are more.
LEAST_ROWS = 10


def lacks(taken: pd.DataFrame, usable: dict[int, int] | None = None) -> bool:
    """Whether a label or most rows are missing, of those that are ``usable`` (by default: of both labels, enough)."""
    if usable is None:
        return taken["__label"].nunique() < 2 or len(taken) < LEAST_ROWS
    return set(taken["__label"]) != set(usable) or len(taken) < min(LEAST_ROWS, sum(usable.values()))


def first_that_fit(sizes: DataFrame, order: list[Column], max_rows: int, max_chars: int) -> pd.DataFrame:
    """Rows in order, each taken if it still fits; a text longer than the whole bound takes no place among the rows."""
    rows = sizes.where(F.col("__chars") <= max_chars).orderBy(*order).limit(max_rows).toPandas()
    total, fits = 0, []
    for chars in rows["__chars"]:
        fits.append(total + chars <= max_chars)
        total += chars if fits[-1] else 0
    return rows[pd.Series(fits, index=rows.index, dtype=bool)]
