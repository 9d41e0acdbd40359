"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are lower-cased and their white space runs become single spaces.  A test item of ``n`` code
points may differ by ``e = floor(n * error_rate)`` insertions, deletions or changes.  It is cut into ``e + 1`` pieces:
wherever it occurs within that budget, one piece occurs unchanged.  All pieces are looked up in one pass over a text
(Aho-Corasick); around each hit Myers' bit-parallel algorithm finds the smallest edit distance of the whole item.

The test set is taken in blocks of bounded size, each against all rows: an automaton has no more nodes than its block
has code points (about 55 bytes each, per worker).  Item ids may be of any type that is written as text and back.  Empty items match nothing; an item shorter
than ``1 / error_rate`` must occur exactly.  Null and empty texts have no hits.  Items that repeat are reported each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointgate.llm.text import filtered, kept_in_worker, pieces, prepare, share, text_column, texts_of


@dataclass(frozen=True)
class LeakOptions:
    error_rate: float = 0.08
    block_chars: int = 800_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of ``pattern`` to any substring of ``text``, and the end of the first such substring."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    full = (1 << len(pattern)) - 1
    high = 1 << (len(pattern) - 1)
    up, down, score = full, 0, len(pattern)
    best, end = score, 0
    for place, c in enumerate(text):
        match = masks.get(c, 0)
        vertical = match | down
        horizontal = (((match & up) + up) ^ up) | match
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus = (plus << 1) & full  # row 0 stays 0: a match may begin anywhere
        minus = (minus << 1) & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        if score < best:
            best, end = score, place + 1
    return best, end


class Matcher:
    """The pieces of a block of test items, and what to check where one is found."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float):
        import ahocorasick

        self.items: list[tuple[object, str, int]] = []
        owners: dict[str, list[tuple[int, int]]] = {}
        for name, text in items:
            plain = normal(text)
            if not plain:
                continue
            budget = int(len(plain) * error_rate)
            self.items.append((name, plain, budget))
            edges = [len(plain) * k // (budget + 1) for k in range(budget + 2)]
            for a, b in zip(edges[:-1], edges[1:]):
                owners.setdefault(plain[a:b], []).append((len(self.items) - 1, a))
        self.automaton = ahocorasick.Automaton()
        for piece, own in owners.items():
            self.automaton.add_word(piece, (len(piece), own))
        if owners:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item, start, end, distance) in the normalised text; overlapping finds of an item are one."""
        if not self.items:
            return []
        plain = normal(text)
        begins: dict[int, set[int]] = {}
        for last, (size, own) in self.automaton.iter(plain):
            for item, offset in own:
                begins.setdefault(item, set()).add(last - size + 1 - offset)
        found = []
        for item in sorted(begins):
            name, pattern, budget = self.items[item]
            places = sorted(begins[item])
            group = [places[0], places[0]]
            groups = [group]
            for place in places[1:]:
                if place - group[1] <= budget:
                    group[1] = place
                else:
                    group = [place, place]
                    groups.append(group)
            done = 0
            for low, high in groups:
                begin = max(low - budget, done, 0)
                region = plain[begin : high + len(pattern) + budget]
                distance, end = myers(pattern, region)
                if distance <= budget:
                    _, back = myers(pattern[::-1], region[max(0, end - len(pattern) - distance) : end][::-1])
                    found.append((name, begin + end - back, begin + end, distance))
                    done = begin + end
        return found


def blocks(benchmark: DataFrame, options: LeakOptions) -> Iterator[list[tuple[object, str]]]:
    """The test set in blocks of about ``block_chars``, which is what the driver and a broadcast hold at once."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("length(text) > 0")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // options.block_chars))
    for number in range(count):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        rows = sorted(block.collect(), key=lambda r: (r["item_id"] or "", r["text"]))
        if rows:
            yield [(r["item_id"], r["text"]) for r in rows]


def leaks(docs: DataFrame, benchmark: DataFrame, options: LeakOptions = LeakOptions()) -> DataFrame:
    """doc_id, item_id, start, end and distance of every occurrence.  One pass over the texts per block, no shuffle."""
    spark = docs.sparkSession
    prepare(spark)
    kind = benchmark.schema["item_id"].dataType
    schema = "doc_id long, item_id string, start long, end long, distance int"
    found = spark.createDataFrame([], schema)
    rows = texts_of(docs)
    for items in blocks(benchmark, options):
        find = scanner(spark, items, options)

        def run(batches: Iterator[pa.RecordBatch], find=find) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches):
                ids = piece.column("doc_id").to_pylist()
                out = [(i, *h) for i, hits in zip(ids, find(text_column(piece))) for h in hits]
                if out:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(("doc_id", "item_id", "start", "end", "distance"), o)) for o in out],
                        pa.schema([("doc_id", pa.int64()), ("item_id", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64()), ("distance", pa.int32())]),
                    )

        found = found.union(rows.mapInArrow(run, schema))
    return found.withColumn("item_id", F.col("item_id").cast(kind))


def scanner(spark, items: list[tuple[object, str]], options: LeakOptions):
    """A function from a column of texts to the hits of each, for use in tasks."""
    shared = share(spark, items)
    name = uuid.uuid4().hex

    def find(texts: pa.Array) -> Iterator[list[tuple[object, int, int, int]]]:
        matcher = kept_in_worker(name, lambda: Matcher(shared(), options.error_rate))
        return (matcher.hits(t) for t in texts.to_pylist())

    return find


def without_leaks(docs: DataFrame, benchmark: DataFrame, options: LeakOptions = LeakOptions()) -> DataFrame:
    """The rows of ``docs`` in which no test item occurs; all columns stay.  One pass per block, no shuffle."""
    left = docs
    for items in blocks(benchmark, options):
        find = scanner(docs.sparkSession, items, options)
        left = filtered(left, lambda texts, find=find: np.array([not hits for hits in find(texts)], bool))
    return left
