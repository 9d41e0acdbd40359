"""Pages that repeat an id and url with other payloads."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

from pointgate.llm import queries, warc

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("url", ["u", None])
def test_each_payload_of_a_repeated_page_is_written(spark, url):
    rows = [(0, "v", "A"), (5, url, "A"), (5, url, "B")]
    got = warc.archive(spark.createDataFrame(rows, SCHEMA)).collect()
    found = sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in got)
    a, b = warc.digest_of(b"A"), warc.digest_of(b"B")
    assert found == sorted([(0, a, "response", None), (5, a, "revisit", 0), (5, b, "response", None)])


def test_two_earlier_payloads_make_no_more_records(spark):
    rows = [(0, "v", "A"), (1, "w", "B"), (5, "u", "A"), (5, "u", "B")]
    got = warc.archive(spark.createDataFrame(rows, SCHEMA)).collect()
    found = collections.Counter((r.page_id, r.payload_digest, r.refers_to) for r in got)
    a, b = warc.digest_of(b"A"), warc.digest_of(b"B")
    assert found == {(0, a, None): 1, (1, b, None): 1, (5, a, 0): 1, (5, b, 1): 1}


def test_null_ids_stay_null_and_come_last(spark):
    rows = [(-7, "u", "A"), (-1, "w", "A"), (None, "w", "A"), (3, "x", "A"), (None, "a", "B"), (None, "b", "B")]
    got = warc.archive(spark.createDataFrame(rows, SCHEMA)).collect()
    found = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert found == {
        (-7, "response", None): 1, (-1, "revisit", -7): 1, (None, "revisit", -7): 1, (3, "revisit", -7): 1,
        (None, "response", None): 1, (None, "revisit", None): 1,
    }


def test_equal_rows_give_one_response(spark):
    rows = [(1, "u", "same")] * 5 + [(None, None, "")] * 4 + [(2, "u", "same")] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = warc.archive(docs).collect()
    found = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert found == {
        (1, "response", None): 1, (1, "revisit", 1): 4, (None, "response", None): 1, (None, "revisit", None): 3,
        (2, "revisit", 1): 2,
    }


def test_short_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    got = warc.archive(spark.createDataFrame(rows, SCHEMA), warc.WarcOptions(min_revisit_bytes=3)).collect()
    assert {r.page_id: r.record_type for r in got} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_very_long_page_and_unique_identifiers(spark, tmp_path):
    rows = [(1, "u", "é" * 3_000_000), (1, "u", "é" * 3_000_000), (2, "v", "short"), (2, "v", "short")]
    folder = f"file://{tmp_path}/bundles"
    index = warc.write_archives(spark.createDataFrame(rows, SCHEMA), folder)
    names = set()
    for path in (tmp_path / "bundles").iterdir():
        with open(path, "rb") as source:
            for place in warc.seek_table(source, path.stat().st_size):
                data, at = warc.read_frame(source, place), 0
                while at < len(data):
                    fields, _, at = warc.parse(data, at)
                    names.add(fields["WARC-Record-ID"])
    assert len(names) == 4 == index.select("record").distinct().count()
    got = warc.read_archives(index, folder).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in got) == [
        (1, 6_000_000, "response"), (1, 6_000_000, "revisit"), (2, 5, "response"), (2, 5, "revisit")
    ]


def test_query_equals_sql(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    again = pages.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") - 100)
    again = again.union(pages.where("page_id % 5 = 0")).union(pages.where("page_id % 7 = 0").withColumn("html", F.lit(None)))
    pages.union(again).union(pages.limit(2).withColumn("page_id", F.lit(None))).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.execute(f"select {', '.join(columns)} from ({queries.ORACLES['op10_warc']})").fetchall()
    got = queries.op10_warc(spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.record_type for r in got} == {"response", "revisit"}
