"""Operators over odd rows, empty tables and the small test tables, against brute force."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pointgate.llm import decontaminate, fingerprints, langid, linededup, lm, neardup, packing, quality, queries, toxicity
from pointgate.llm import warc
from tests.llm.conftest import DATA, LINE, ODD, bag, classes

FILE = queries.TOKENIZER
ROWS = len(ODD)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, i % 2) for i in range(1, 12)] + [(1, 0, 0), (None, 1, 1), (4, None, None), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_rows_are_scored(odd, nothing, labels):
    for make in (lambda d: quality.quality_scores(d, labels), lambda d: toxicity.toxicity_scores(d, labels)):
        got = make(odd).collect()
        assert len(got) == ROWS and all(0 <= r.score <= 1 for r in got)
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
        assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1  # no words at all
        assert make(nothing).count() == 0
    no_labels = labels.where("false")
    assert {r.predicted for r in toxicity.toxicity_scores(odd, no_labels).collect()} == {0}
    assert {r.score for r in quality.quality_scores(odd, no_labels).collect()} == {0.5}


def test_odd_languages(odd, nothing):
    got = langid.identify(odd).collect()
    assert len(got) == ROWS
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in got} <= {"en", "fr", "de", "und"}
    assert langid.identify(nothing).count() == 0
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_odd_fingerprints(odd, nothing):
    got = fingerprints.edited_fingerprints(odd).collect()
    assert len(got) == ROWS
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == ""
    assert by_id[4].fingerprint == by_id[7].fingerprint != by_id[5].fingerprint
    assert by_id[3].near_next == 1.0 and by_id[4].near_next == 0.0  # both without words; one without
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert by_id[10].n_chars == 200_000
    assert fingerprints.edited_fingerprints(nothing).count() == 0


def test_fingerprints_estimate_jaccard(table, texts):
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(table("documents")).collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    wrong = []

    def shingles(t):
        words = t.split()
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    for i, t in texts.items():
        cut = len(t) // 3
        edited = t[: len(t) - cut] + texts[following[i]][:cut]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(t), shingles(edited)
        wrong.append(got[i].near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(wrong)) < 0.01 and np.std(wrong) < 0.045


def test_odd_near_classes(odd, nothing):
    got = collections.defaultdict(set)
    rows = neardup.near_classes(odd).collect()
    for r in rows:
        got[r.doc_id].add(r.class_id)
    assert len(rows) == ROWS
    assert got[1] == got[2] == got[3] == {1} and got[7] == {4} and got[None] == {None} and got[10] == {10}
    assert neardup.near_classes(nothing).count() == 0
    kept = neardup.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "4", "5", "6", "8", "9", "9", "10", "11", "None"])


def test_near_classes_equal_brute_force(table, texts):
    got = {r.doc_id: r.class_id for r in neardup.near_classes(table("documents")).collect()}
    assert got == classes(texts)


def test_group_of_chained_copies_in_small_blocks(spark):
    """A chain in which only neighbours are alike, and near copies at the threshold: no link may be lost."""
    words = [f"w{k}" for k in range(400)]
    texts = {i: " ".join(words[i * 3 : i * 3 + 60]) for i in range(60)}
    texts |= {1000 + i: " ".join(words[:40] + [f"x{i}"] + words[41:90]) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for size in (4_000, 2_000_000):
        got = neardup.near_classes(docs, neardup.NearOptions(block_bytes=size)).collect()
        assert {r.doc_id: r.class_id for r in got} == classes(texts)


def test_one_row_stays_of_each_class(spark):
    rows = [
        (1, "one two three four five six"), (1, "one two three four five six"), (1, "ONE two three  four five six"),
        (2, "one two three four five six"), (2, "seven eight nine ten eleven twelve"), (None, "one two three four five six"),
        (None, "only here and without an id"), (None, "only here and without an id"), (None, "ONLY here and without an id"),
        (3, None), (3, ""), (None, " "),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    kept = neardup.one_of_each(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "None"]
    assert {r.text.split()[0].lower() for r in kept if r.text} == {"one", "seven", "only"}


def test_lm_counts_and_gain(table, texts):
    got = lm.lm_scores(table("documents"), lm.LmOptions(chunk_chars=50_000)).collect()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", t.translate(fold)) + [None] for i, t in texts.items()}
    count = collections.Counter(
        w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws
    )
    n, v = sum(count.values()), len(count)
    gain = 0.0
    for r in got:
        words = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(count[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words), abs_tol=1e-6)
        gain += r.score - r.base_score if r.held_out else 0
    assert len(got) == len(texts) and gain > 0


def test_odd_lm(odd, nothing):
    got = lm.lm_scores(odd).collect()
    assert len(got) == ROWS
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)
    assert lm.lm_scores(nothing).count() == 0
    unlearned = lm.lm_scores(odd.where("doc_id is null")).collect()
    assert [(r.train_tokens, r.base_score, r.score) for r in unlearned] == [(0, 0.0, 0.0)]


def test_packing_round_trip(odd, nothing, spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(FILE)
    docs = odd.where("doc_id != 9 or doc_id is null")
    pieces = packing.packed(docs, FILE, packing.PackOptions(length=64)).collect()
    expected = {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    found, used = collections.defaultdict(list), collections.defaultdict(list)
    for p in sorted(pieces, key=lambda p: (str(p.doc_id), p.start)):
        ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert p.start == len(found[p.doc_id]) and p.length == len(ids) and p.doc_tokens == len(expected[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids))
        found[p.doc_id] += ids
        used[p.sequence_id].append((p.offset, p.length))
    assert found == expected
    for spans in used.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end == 64 or end & (end - 1) == 0
    assert packing.packed(nothing, FILE, with_ids=False).count() == 0
    assert sum(p.doc_id == 9 and p.start == 0 for p in packing.packed(odd, FILE).collect()) == 3


def test_leaks_equal_brute_force(table, texts):
    got = decontaminate.leaks(table("documents"), table("benchmark"), decontaminate.LeakOptions(block_chars=3_000))
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    items = {r.item_id: decontaminate.normal(r.text) for r in table("benchmark").collect()}
    exact = {(i, k) for i, t in texts.items() for k, item in items.items() if item in decontaminate.normal(t)}
    assert exact and exact <= found
    for i, k in found - exact:
        assert decontaminate.myers(items[k], decontaminate.normal(texts[i]))[0] <= int(len(items[k]) * 0.08)
    clean = decontaminate.without_leaks(table("documents"), table("benchmark"))
    assert {r.doc_id for r in clean.select("doc_id").collect()} == set(texts) - {i for i, _ in found}


def test_odd_leaks(odd, nothing, spark):
    items = spark.createDataFrame([(1, LINE), (1, LINE), (2, None), (3, "")], "item_id long, text string")
    hits = decontaminate.leaks(odd, items).collect()
    assert {(r.doc_id, r.item_id) for r in hits} == {(i, 1) for i in (4, 5, 6, 7, 8)}
    left = decontaminate.without_leaks(odd, items)
    assert left.columns == odd.columns and left.count() == ROWS - 5
    assert decontaminate.leaks(nothing, items).count() == 0
    assert decontaminate.leaks(odd, items.where("false")).count() == 0


def test_odd_lines(odd, nothing):
    got = collections.defaultdict(list)
    left = linededup.without_boilerplate(odd)
    assert left.columns == odd.columns and left.dtypes == odd.dtypes
    for r in left.collect():
        got[r.doc_id].append(r.text)
    assert got[1] == [None] and got[2] == [""] and len(got[9]) == 3
    assert got[4][0].startswith(LINE)  # the first keeps it
    assert got[6] == ["red green blue white black grey pink brown"]
    assert LINE not in got[5][0] + got[7][0] + got[8][0]
    assert sum(map(len, got.values())) == ROWS
    assert linededup.without_boilerplate(nothing).count() == 0
    four = linededup.without_boilerplate(odd.where("source != 'e'"))  # one site below the threshold
    assert four.where(F.col("text").contains(LINE)).count() == 4


def test_short_lines_and_long_texts(spark):
    """Short lines count too, blank ones stay, and a text of 60,000 lines with half of them removed takes no longer than its length."""
    rows = [(k, f"a\n\n  \nown line {k}\n b ", f"s{k}") for k in range(1, 6)]
    many = [w for k in range(30_000) for w in ("a", f"x{k}")]
    rows.append((9, "\n".join(many), "s9"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in linededup.without_boilerplate(docs).collect()}
    assert got[1] == "a\n\n  \nown line 1\n b "
    assert all(got[k] == f"\n  \nown line {k}" for k in range(2, 6))
    assert got[9] == "\n".join(many[1::2])


def test_line_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{DATA}/documents.parquet')")
    order = ["doc_id", "n_lines", "n_removed", "text_md5"]
    got = queries.op9_linededup(spark, DATA).select(*order).collect()
    want = con.execute(f"select {', '.join(order)} from ({queries.OP9_SQL})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_archives(spark, table):
    rows = [(1, "u", "same"), (2, "v", "same"), (3, "w", None), (4, None, ""), (5, "x", "é" * 3000), (0, "z", "same")]
    rows += [(2, "a", "same"), (None, "n", "same"), (2, "v", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in warc.archive(pages, warc.WarcOptions(frame_bytes=300, bundle_bytes=100)).collect():
        got[r.page_id].append((r.record_type, r.refers_to, r.payload_bytes))
    assert got[0] == [("response", None, 4)] and got[1] == [("revisit", 0, 4)]
    assert got[2] == [("revisit", 0, 4)] * 3 and got[None] == [("revisit", 0, 4)]
    assert got[3] == [("response", None, 0)] and got[4] == [("revisit", 3, 0)] and got[5] == [("response", None, 6000)]
    assert warc.archive(pages.where("false")).count() == 0
    html = {r.page_id: (r.html or "").encode() for r in table("pages").collect()}
    done = queries.op10_warc(spark, DATA).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in done} == {
        k: (len(v), warc.digest_of(v)) for k, v in html.items()
    }


@pytest.mark.parametrize("label,make", [("quality", quality.quality_scores), ("toxic", toxicity.toxicity_scores)])
def test_classifiers_on_held_out_rows(spark, label, make):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    truth = labels.select("doc_id", label)
    rows = make(docs.join(truth, "doc_id", "left_semi"), labels).where("held_out").join(truth, "doc_id").collect()
    right = np.mean([r.predicted == r[label] for r in rows])
    assert len(rows) > 500 and right > 0.97


def test_languages_on_held_out_rows(table):
    docs = table("documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in langid.identify(docs).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got]) > 0.9


def test_pipeline_stages(spark, table, texts):
    docs = table("documents")
    columns = docs.columns
    toxic = {r.doc_id for r in toxicity.toxicity_scores(docs, table("labels")).collect() if r.predicted}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        if name == "packing":
            break
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, DATA)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            assert set(after) == set(before) - toxic
        elif name == "line_dedup":
            assert set(after) == set(before) and all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_dedup":
            assert set(after) == set(classes({i: r.text for i, r in before.items()}).values())
        else:
            items = [decontaminate.normal(r.text) for r in table("benchmark").collect()]
            clean = {
                i for i, r in before.items()
                if not any(decontaminate.myers(x, decontaminate.normal(r.text))[0] <= int(len(x) * 0.08) for x in items)
            }
            assert set(after) == clean and after and not any(
                x in decontaminate.normal(r.text) for x in items for r in after.values()
            )
    pieces = corpus_pipeline.run(spark, DATA).collect()
    assert {p.doc_id for p in pieces} == set(after)
    from tokenizers import Tokenizer

    plain, ids = Tokenizer.from_file(FILE), collections.defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.start):
        ids[p.doc_id] += np.frombuffer(bytes(p.ids), "<u4").tolist()
    assert ids == {i: plain.encode(r.text, add_special_tokens=False).ids + [1] for i, r in after.items()}
    used = collections.Counter()
    for p in pieces:
        used[p.sequence_id] += p.length
    assert all(v == 2048 or v & (v - 1) == 0 for v in used.values())


def test_bag_counts_repeats():
    assert sum(bag("a a a a a a").values()) == 2
