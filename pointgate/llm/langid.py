"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams (one to three letters, words padded with a
border mark) in order of frequency.  A document's own list is compared with each profile by the out-of-place
distance: the sum of rank differences, with the profile's size for an n-gram the profile lacks.  The nearest profile
names the language; ties go to the alphabetically first.

Text without a letter (null and empty included) is ``und`` with score 0; so is every text when nothing was learned.
The score is ``second / (best + second)`` of the two smallest mean distances, or one minus the distance when only one
language is known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointgate.llm.text import fold, held_out, kept_in_worker, pieces, prepare, share, text_column, texts_of

UNKNOWN = "und"
_BORDER = 1
_SHIFT = 21  # code points fit in 21 bits: three of them fit in one 64-bit key


@dataclass(frozen=True)
class LangOptions:
    profile_size: int = 300
    modulus: int = 4
    remainder: int = 2


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


def letters(text: str, table: np.ndarray) -> np.ndarray:
    """Lower-case letters as code points, with one border mark before, between and after words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(table[points], points, _BORDER)
    points = np.concatenate([[_BORDER], points, [_BORDER]])
    border = points == _BORDER
    return points[~(border & np.concatenate([[False], border[:-1]]))]


def grams(points: np.ndarray) -> np.ndarray:
    """Keys of all n-grams of one to three marks inside words; no n-gram crosses a border."""
    inner = points != _BORDER
    one = points[inner]
    two = (points[:-1] << _SHIFT) | points[1:]
    three = (two[:-1] << _SHIFT) | points[2:] if len(points) > 2 else np.zeros(0, np.int64)
    return np.concatenate([one, two, three[inner[1:-1]]])


def ranked(points: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by key."""
    return most_frequent(*np.unique(grams(points), return_counts=True), size)


def most_frequent(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.argsort(-counts, kind="stable")][:size]


@dataclass(frozen=True)
class Profiles:
    """All profiles as one matrix: the rank of each known n-gram per language (the size where it is missing)."""

    names: list[str]
    keys: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, lists: dict[str, np.ndarray], size: int) -> Profiles:
        names = sorted(lists)
        keys = np.unique(np.concatenate([*lists.values(), np.zeros(0, np.int64)])).astype(np.int64)
        ranks = np.full((len(names), len(keys) + 1), size, np.int32)  # the last column: known to no language
        for row, name in enumerate(names):
            ranks[row, np.searchsorted(keys, lists[name])] = np.arange(len(lists[name]))
        return cls(names, keys, ranks, size)

    def predict(self, points: np.ndarray) -> tuple[str, float]:
        if len(points) <= 1 or not self.names:
            return UNKNOWN, 0.0
        own = ranked(points, self.size)
        at = np.searchsorted(self.keys, own)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == own
        ranks = self.ranks[:, np.where(known, at, len(self.keys))]
        apart = np.where(ranks < self.size, np.abs(ranks - np.arange(len(own))), self.size)
        far = apart.sum(axis=1) / (len(own) * self.size)
        order = np.argsort(far, kind="stable")
        best = float(far[order[0]])
        if len(order) == 1:
            return self.names[0], 1.0 - best
        second = float(far[order[1]])
        return self.names[order[0]], second / (best + second) if best + second else 0.5


def local_profiles(texts: list[str], langs: list[str | None], size: int) -> Profiles:
    """Profiles of texts at hand, counted a few texts at a time."""
    table = letter_table()
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for lang in sorted({x for x in langs if x is not None}):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        own = [t for t, x in zip(texts, langs) if x == lang]
        for begin in range(0, len(own), 100):
            part = np.concatenate([letters(t, table) for t in own[begin : begin + 100]])
            more, times = np.unique(grams(part), return_counts=True)
            keys, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, times]), len(keys)).astype(np.int64)
        if len(keys):
            found[lang] = (keys, counts)
    return Profiles.of({lang: most_frequent(*kc, size) for lang, kc in found.items()}, size)


def learn_profiles(docs: DataFrame, options: LangOptions = LangOptions()) -> Profiles:
    """Count the n-grams of every training document; only the ranked lists come to the driver.

    A task sends one row per language and distinct n-gram of a piece of text, summed again before the shuffle.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"),
    ).where("text is not null and lang is not null")
    rows = rows.where(fold(F.col("doc_id"), options.modulus) != options.remainder).drop("doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_in_worker("letters", letter_table)
        for piece in pieces(batches):
            langs = piece.column("lang").to_pylist()
            parts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(langs, text_column(piece).to_pylist()):
                parts.setdefault(lang, []).append(letters(text, table))
            for lang, found in parts.items():
                keys, counts = np.unique(grams(np.concatenate(found)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("gram"))
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= options.profile_size)
    lists: dict[str, list[int]] = {}
    for row in top.select("lang", "place", "gram").orderBy("lang", "place").collect():
        lists.setdefault(row["lang"], []).append(row["gram"])
    return Profiles.of({k: np.array(v, np.int64) for k, v in lists.items()}, options.profile_size)


def identify(docs: DataFrame, options: LangOptions = LangOptions()) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs``."""
    profiles = learn_profiles(docs, options)
    shared = share(docs.sparkSession, profiles)  # profile_size numbers per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_in_worker("letters", letter_table)
        for piece in pieces(batches):
            found = [shared().predict(letters(t, table)) for t in text_column(piece).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"),
                 pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = texts_of(docs).withColumn("held_out", held_out(F.col("doc_id"), options.modulus, options.remainder))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
