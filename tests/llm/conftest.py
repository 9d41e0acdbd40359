import collections
import os

import pytest
from pyspark.sql import types as T

DATA = "/root/testdata/sf0.001"

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("node", T.StringType()),
        T.StructField("row_id", T.StringType()),
        T.StructField("gone", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)
LINE = "this very line stands on many sites at once"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "b", 4),
    (4, f"{LINE}\nalpha beta gamma delta epsilon zeta eta theta", "en", "a", None),
    (5, f"{LINE}\none two three four five six seven eight", "en", "b", None),
    (6, f"{LINE}\n{LINE}\nred green blue white black grey pink brown", "en", "c", None),
    (7, f"{LINE}\nalpha beta gamma delta epsilon zeta eta theta", "en", "d", None),
    (8, f"{LINE}\nnorth south east west up down left right", "en", "e", None),
    (9, "é日本 ß İstanbul ΣΑΣ. 12 <|endoftext|> x", None, "a", None),
    (9, "é日本 ß İstanbul ΣΑΣ. 12 <|endoftext|> x", None, "a", None),
    (9, "another text under the same id", "fr", None, None),
    (None, "a row without an id", "en", "a", None),
    (10, "long " * 40_000, "en", "a", 200_000),
    (11, "word", "de", "a", 4),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(*r, "n", "r", "g", "s") for r in ODD], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    return lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")


@pytest.fixture(scope="session")
def texts(table):
    return {r.doc_id: r.text for r in table("documents").collect()}


def bag(text):
    words = (text or "").lower().split()
    if not words:
        return collections.Counter()
    return collections.Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def classes(texts, threshold=0.8):
    """Smallest id of each text's class, comparing all texts that share a shingle."""
    bags = {i: bag(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(set)
    for i, b in bags.items():
        for s in b or [None]:
            holders[s].add(i)
    pairs = {(a, b) for group in holders.values() for a in group for b in group if a < b}
    for a, b in pairs:
        x, y = bags[a], bags[b]
        least, most = sum((x & y).values()), sum((x | y).values())
        if most == 0 or least >= threshold * most:
            p, q = top(a), top(b)
            root[max(p, q)] = min(p, q)
    return {i: top(i) for i in texts}
