"""Registered queries of the corpus operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.llm.collocation import collocations
from pointgate.llm.decontaminate import leaks
from pointgate.llm.fingerprints import edited_fingerprints
from pointgate.llm.langid import identify
from pointgate.llm.linededup import edited
from pointgate.llm.lm import lm_scores
from pointgate.llm.manifest import folded_up, manifest, siblings
from pointgate.llm.neardup import near_classes
from pointgate.llm.oracles import OP9_SQL, OP10_SQL, OP11_SQL, OP12_SQL, OP13_SQL
from pointgate.llm.packing import packed
from pointgate.llm.quality import quality_scores
from pointgate.llm.secretscan import BASE_RULES, listed, secret_spans
from pointgate.llm.text import fold
from pointgate.llm.toxicity import toxicity_scores
from pointgate.llm.warc import archive

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = edited(table(spark, sf_dir, "documents"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.md5(F.col("new_text")).alias("text_md5")
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [r.name for r in BASE_RULES]

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return secret_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", *map(number, kinds), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(fold(F.col("doc_id"), 3) == 0, lower).otherwise(F.col("text"))
    made = manifest(table(spark, sf_dir, "documents"), {"text": tampered})
    return made.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
        folded_up(F.col("leaf_now"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).drop("first_doc")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_fingerprints, op3_lm, op4_neardup, op5_packing,
        op6_decontaminate, op7_langid, op8_toxicity, op9_linededup, op10_warc,
        op11_secrets, op12_manifest, op13_collocation,
    )
}
ORACLES: dict[str, str] = {
    "op9_linededup": OP9_SQL.strip(),
    "op10_warc": OP10_SQL.strip(),
    "op11_secrets": OP11_SQL.strip(),
    "op12_manifest": OP12_SQL.strip(),
    "op13_collocation": OP13_SQL.strip(),
}
