"""Operators write their steps to the shared folder; a ``scratch`` block around them leaves nothing there."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pointgate import session
from pointgate.llm import queries
from pointgate.session import scratch


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    before = session.shared_dir(spark)
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    yield tmp_path / "shared"
    spark.sparkContext.setCheckpointDir(before)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """The test tables with few documents, odd ones among them, under other names too."""
    root = tmp_path_factory.mktemp("tables")
    for name in ("documents", "labels", "benchmark", "pages"):
        frame = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name == "documents":
            frame = frame.where("doc_id < 60")
            odd = frame.where("doc_id < 6").withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.lit("")))
            frame = frame.union(odd.withColumn("doc_id", F.when(F.col("doc_id") > 2, F.col("doc_id"))).withColumn("lang", F.lit(None)))
            frame = frame.withColumns({c: F.lit("clash") for c in ("row", "node", "keep_id", "curve", "__part", "n")})
        frame.write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", [*queries.QUERIES, "pipeline"])
def test_nothing_is_left_after_the_result_is_written(spark, small, folder, tmp_path, name):
    make = corpus_pipeline.run if name == "pipeline" else queries.QUERIES[name]
    with scratch(spark):
        make(spark, small).write.parquet(str(tmp_path / "result"))
    assert spark.read.parquet(str(tmp_path / "result")).columns
    assert [n for _, _, names in os.walk(folder) for n in names] == []


def test_pipeline_over_odd_rows_and_empty_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.where("false"), small)
        assert empty.count() == 0, name
        after = stage(spark, docs, small)
        if name == "packing":
            assert after.where("start = 0").count() == docs.count()
            continue
        assert after.columns == docs.columns, name
        rows = {(r.doc_id, r.row, r.keep_id) for r in after.collect()}
        assert rows and all(r[1:] == ("clash", "clash") for r in rows)
        if name == "near_dedup":
            wordless = after.where("text is null or trim(text) = ''").collect()
            assert len(wordless) == 1 and wordless[0].doc_id == 3  # the smallest id of the texts without words
