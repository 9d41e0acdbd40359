"""A corpus from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the last return the
columns of ``documents``:

1. toxicity: documents judged toxic go;
2. line dedup: lines that many sites share go from all documents but the first (documents stay, ``n_chars`` follows);
3. near-dedup: of each class of near copies the document with the smallest id stays;
4. decontamination: documents with a benchmark item in them go;
5. packing: the rest becomes pieces of full training sequences, with their token ids.

Odd rows: a null or empty text is not toxic, has no lines to lose and no benchmark item in it; all texts without words
are one class of copies; the one that stays is the end token alone.  Rows without ``doc_id`` are judged like all
others, and one of them stays of a class only if no row of it has an id.  Rows that repeat are copies of each other.
Columns beyond those of ``documents`` pass through, whatever their names.  Empty tables give no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.llm.decontaminate import without_leaks
from pointgate.llm.linededup import without_boilerplate
from pointgate.llm.neardup import one_of_each
from pointgate.llm.packing import packed
from pointgate.llm.queries import TOKENIZER, table
from pointgate.llm.text import materialise
from pointgate.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = without_boilerplate(docs)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier, the signatures and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
