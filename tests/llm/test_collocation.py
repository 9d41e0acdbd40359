"""Phrase collocations against plain counting, with odd rows and small blocks."""

import collections
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from pointgate.llm import collocation, queries
from pointgate.llm.collocation import PhraseOptions, collocations
from tests.llm.conftest import DATA

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, options):
    """The contract, by plain counting."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, options.longest + 1):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    good = {p: a for p, a in f.items() if len(p) > 2 and a >= options.least}
    covers = collections.defaultdict(int)
    for p, a in good.items():
        for size in range(2, len(p) - 1):
            for i in range(1, len(p) - size + 1):
                key = (p[0], *p[i : i + size])
                covers[key] = max(covers[key], a)
    out = []
    for p, a in good.items():
        if 100 * covers[p] >= options.covered * a and covers[p]:
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            left, right = f[p[: k + 1]], f[(p[0], *p[k + 1 :])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((p[0], -score, -a, " ".join(p[1:]).encode(), left, right))
    out.sort()
    rank, done = collections.Counter(), []
    for lang, score, a, phrase, left, right in out:
        rank[lang] += 1
        if rank[lang] <= options.top:
            done.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return done


def collected(docs, options=PhraseOptions()):
    return sorted(tuple(r) for r in collocations(docs, options).select(*COLUMNS).collect())


@pytest.mark.parametrize("change", [{}, {"block_bytes": 40}, {"bitmap_bits": 7}, {"print_bits": 4}, {"longest": 3, "top": 5}, {"longest": 6}])
def test_equals_plain_counting(spark, change):
    make = random.Random(7)
    words = ["a", "bb", "Ccc", "été", "x" * 60, "(d)", "日本"]
    rows = [
        (k, make.choice(["en", "fr", None]), make.choice(["", " "]) + "".join(
            make.choice(words) + make.choice([" ", " ", "  ", "\t", ", ", ".\n", "\r"]) for _ in range(make.randrange(40))
        )) for k in range(120)
    ]
    rows += [(1, "en", "a bb Ccc"), (1, "en", "a bb Ccc"), (None, None, "a bb"), (5, "de", None), (6, "", "a bb " * 30)]
    options = PhraseOptions(least=4, **change)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("print", F.lit("clash"))
    want = sorted(plain([r[1:] for r in rows], options))
    assert len(want) > 5
    assert collected(docs, options) == want


def test_colliding_fingerprints_are_parted_by_text(spark, monkeypatch):
    rows = [(k, "en", "one two three. four five six") for k in range(40)] + [(99, "en", "one five")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    usual = collocation.mix
    monkeypatch.setattr(collocation, "mix", lambda v: usual(v) & collocation.np.uint64(3))  # four fingerprints in all
    got = collected(docs)
    assert got == sorted(plain([r[1:] for r in rows], PhraseOptions())) and len(got) == 2


def test_pointer_to_the_first_document(spark):
    rows = [(3, "en", "x. é New  York"), (2, "en", "a, new york is new york"), (7, "en", "new york")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    (got,) = [r for r in collocations(docs, PhraseOptions(least=3)).collect() if r.phrase == "new york"]
    assert (got.a, got.first_doc) == (4, 2)


def test_odd_and_empty(odd, nothing):
    assert collocations(nothing).count() == 0
    rows = [(r.lang, r.text) for r in odd.collect()]
    options = PhraseOptions(least=3)
    assert collected(odd, options) == sorted(plain(rows, options))
    assert collected(odd) == sorted(plain(rows, PhraseOptions()))  # one text of 40,000 equal words


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{DATA}/documents.parquet')")
    want = con.execute(f"select {', '.join(COLUMNS)} from ({queries.ORACLES['op13_collocation']})").fetchall()
    got = queries.op13_collocation(spark, DATA).select(*COLUMNS).collect()
    assert want and sorted(map(tuple, got)) == sorted(want)
