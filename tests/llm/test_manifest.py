"""The Merkle manifest against a plain tree, and its proofs."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from pointgate.llm import queries
from pointgate.llm.manifest import ManifestOptions, folded_up, manifest, siblings
from tests.llm.conftest import DATA, SCHEMA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """The root, and for each node its siblings by level as (before, after)."""
    at, steps = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, own in enumerate(steps):
            begin = at[k] - at[k] % fanout
            own.append((nodes[begin : at[k]], nodes[at[k] + 1 : begin + fanout]))
            at[k] //= fanout
        nodes = [digest("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
    return nodes[0], steps


def plain(rows, fanout):
    """doc_id, leaf, subroot, root, digest of the proof, root folded from the lower-cased row."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in groups[g]], fanout) for g in order]
    root, tops = tree([t[0] for t in trees], fanout) if trees else (None, [])
    out = []
    for g, (subroot, steps), top in zip(order, trees, tops):
        for r, own in zip(groups[g], steps):
            path = [("".join(a), "".join(b)) for a, b in own + top]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            node = leaf((*r[:4], r[4].translate(LOWER)) if tampered else r)
            for before, after in path:
                node = digest(before + node + after)
            out.append((r[0], leaf(r), subroot, root, digest("".join(a + b for a, b in path)), node))
    return sorted(out, key=str)


def made(docs, options):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lower).otherwise(F.col("text"))
    rows = manifest(docs, {"text": text}, options).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256),
        folded_up(F.col("leaf_now"), F.col("steps")),
    )
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize(
    "count,fanout,levels", [(0, 8, 3), (1, 8, 3), (8, 8, 1), (9, 8, 1), (150, 2, 1), (161, 2, 2), (515, 8, 1), (600, 3, 2)]
)
def test_equals_plain_tree(spark, count, fanout, levels):
    make = random.Random(count)
    langs = ["en"] * 3 + ["fr", None, "", "é"] if count > 9 else ["en"]
    rows = [
        (
            None if k % 41 == 40 else k - k % 3 % 2, make.choice(["a", None]),
            make.choice(langs) if k % 5 else f"l{k % 10}" if count > 500 else "en",
            make.choice([k, None]), make.choice(["Hello Wörld", "", None, "ABC"]),
        ) for k in range(count)
    ]
    docs = spark.createDataFrame(
        [(i, text, lang, source, n, "n", "r", "g", "s") for i, source, lang, n, text in rows + rows[:2]], SCHEMA
    ).withColumnRenamed("node", "block").withColumnRenamed("gone", "rank")
    assert made(docs, ManifestOptions(fanout, levels)) == plain(rows + rows[:2], fanout)


def test_odd_and_empty(odd, nothing):
    assert made(nothing, ManifestOptions()) == []
    rows = [tuple(r)[:5] for r in odd.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert made(odd, ManifestOptions()) == plain(rows, 8)


def test_proof_of_one_row_stands_alone(spark, table):
    rows = manifest(table("documents"), options=ManifestOptions(levels=1)).collect()
    assert len({r.root for r in rows}) == 1
    for r in rows:
        node = r.leaf
        for s in r.steps:
            node = digest(s.before + node + s.after)
        assert node == r.root and r.leaf == r.leaf_now


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{DATA}/documents.parquet')")
    rows = queries.op12_manifest(spark, DATA).collect()
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = con.execute(f"select {', '.join(columns)} from ({queries.ORACLES['op12_manifest']})").fetchall()
    assert sorted(tuple(r[c] for c in columns) for r in rows) == sorted(want)
    assert {r.verified for r in rows} == {True, False}
