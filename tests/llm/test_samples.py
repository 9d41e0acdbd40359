"""The sample for fitting when labelled texts are longer than its bounds."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointgate.llm import samples, toxicity

LABELS = "doc_id long, toxic int"


@pytest.fixture(scope="module")
def ids(spark):
    """Ids outside the held-out fold, in the order of the sample."""
    rows = spark.range(1, 200).select(F.col("id"), F.xxhash64("id").alias("h")).orderBy("h", "id").collect()
    return [r.id for r in rows if zlib.crc32(str(r.id).encode()) % 5]


def made(spark, rows):
    """Rows of id, text and label as documents and labels."""
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, k) for i, _, k in rows], LABELS)


def test_a_long_text_first_leaves_the_others(spark, ids):
    rows = [(i, "bad word here" if n % 2 else "good day there", n % 2) for n, i in enumerate(ids[:60])]
    rows[0] = (ids[0], "long " * 1000, 0)
    docs, labels = made(spark, rows)
    got = samples.labelled_sample(docs, labels, "toxic", max_chars=2000)
    assert set(got["doc_id"]) == set(ids[1:60])
    options = toxicity.ToxicityOptions(max_chars=2000)
    scored = toxicity.toxicity_scores(docs, labels, options).collect()
    assert all(r.predicted == n % 2 for n, i in enumerate(ids[:60]) for r in scored if n and r.doc_id == i)


def test_texts_that_overflow_are_passed_over_one_by_one(spark, ids):
    rows = [(i, "x" * (60 if n % 3 == 1 else 10), n % 2) for n, i in enumerate(ids[:30])]
    got = samples.labelled_sample(*made(spark, rows), "toxic", max_rows=30, max_chars=300)
    assert got["text"].str.len().sum() == 300 and len(got) > 10


def test_long_texts_take_no_place_among_the_rows(spark, ids):
    rows = [(i, "x" * (500 if n < 20 else 5), n % 2) for n, i in enumerate(ids[:40])]
    got = samples.labelled_sample(*made(spark, rows), "toxic", max_rows=20, max_chars=400)
    assert set(got["doc_id"]) == set(ids[20:40])


def test_a_rare_label_is_looked_for(spark, ids):
    rows = [(i, f"text {n}", int(n >= 95)) for n, i in enumerate(ids[:100])]
    got = samples.labelled_sample(*made(spark, rows), "toxic", max_rows=40)
    assert set(got["doc_id"][got["label"] == 1]) == set(ids[95:100]) and np.sum(got["label"] == 0) == 20


def test_no_silent_sample_without_a_label(spark, ids):
    rows = [(i, "x" * (1000 if n % 2 else 5), n % 2) for n, i in enumerate(ids[:40])]
    with pytest.raises(ValueError, match="usable"):
        samples.labelled_sample(*made(spark, rows), "toxic", max_chars=900)
    one_kind = [(i, t, 0) for i, t, _ in rows]  # nothing to look for: the label does not exist
    assert set(samples.labelled_sample(*made(spark, one_kind), "toxic", max_chars=900)["label"]) == {0}


def test_repeated_ids_count_once(spark, ids):
    rows = [(i, "same text", n % 2) for n, i in enumerate(ids[:20])]
    docs, labels = made(spark, rows)
    again = docs.where(F.col("doc_id") == ids[0]).crossJoin(spark.range(50)).select("doc_id", "text")
    got = samples.labelled_sample(docs.union(again), labels, "toxic", max_rows=20)
    assert set(got["doc_id"]) == set(ids[:20])


def test_the_fit_takes_every_labelled_row_of_all_parts(spark, ids):
    """Words that only a few rows hold, far behind the first rows of any sample, are learnt."""
    rows = [(i, f"day{n % 7} good rare{n}", int(n >= 90)) for n, i in enumerate(ids[:120])]
    rows = [(i, text + " filthy" if k else text, k) for i, text, k in rows]
    docs, labels = made(spark, rows)
    options = toxicity.ToxicityOptions(max_rows=40)
    parts = samples.labelled_rows(docs.union(docs), labels, "toxic", 5, 0, 40, 256).collect()
    assert sorted(r.doc_id for r in parts) == sorted(ids[:120])
    assert len({r.part for r in parts}) == 3
    one = toxicity.fitted(docs, labels, options)
    other = toxicity.fitted(docs.repartition(3), labels.repartition(2), options)
    untouched, kept = toxicity.Network.new(options).embeddings, aside(spark, ids)
    for n in range(120):
        if ids[n] not in kept:
            at = toxicity.places_of([f"rare{n}"], options.bits)[0][0]
            assert (one.embeddings[at] != untouched[at]).any(), n
    assert (one.embeddings == other.embeddings).all() and one.thresholds == other.thresholds
    assert one.common_threshold == other.common_threshold


def aside(spark, ids):
    """Ids kept for the thresholds."""
    rows = spark.range(1, 200).where("pmod(xxhash64(id), 5) = 4").collect()
    return {r.id for r in rows} & set(ids)
