"""Quality classifier: logistic regression over hashed word n-grams, fitted with follow-the-regularised-leader.

A document is a sparse vector: words and word pairs, and the same for the words' shapes (case, closing marks, a
repeat of the word before), hashed to ``2**bits`` places; a place counts ``log(1 + occurrences)`` and the vector has
length one.  A score is the logistic of one sparse dot product.

Empty and null texts have no features and score by the intercept alone.  Equal texts score equally.  Without usable
labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointgate.llm.samples import labelled_sample
from pointgate.llm.text import hash_words, held_out, mix, pieces, row_of, share, split_words, sum_rows
from pointgate.llm.text import text_column, texts_of


@dataclass(frozen=True)
class QualityOptions:
    bits: int = 18
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    max_rows: int = 8_000
    max_chars: int = 30_000_000
    threshold: float = 0.3
    modulus: int = 5
    remainder: int = 0


def shape(word: str) -> str:
    """Case of the letters and the marks that close the word."""
    body = word.rstrip("".join(c for c in set(word) if not c.isalnum()))
    if not body:
        case = "m"
    elif body.isdigit():
        case = "d"
    elif len(body) > 1 and body.isupper():
        case = "U"
    elif body[0].isupper():
        case = "T"
    else:
        case = "l"
    return case + word[len(body) :][:8]


def vectors(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ragged rows of (place, value): offsets, places, values."""
    offsets, codes, distinct = split_words(texts)
    words = hash_words([w.lower() for w in distinct], 1)[codes] if len(codes) else np.zeros(0, np.uint64)
    shapes = hash_words([shape(w) for w in distinct], 2)[codes] if len(codes) else np.zeros(0, np.uint64)
    rows = row_of(offsets)
    pairs = np.flatnonzero(rows[1:] == rows[:-1]) if len(rows) else np.zeros(0, np.int64)
    again = (words[pairs] == words[pairs + 1]).astype(np.uint64)
    with np.errstate(over="ignore"):
        keys = np.concatenate(
            [
                words,
                mix(words[pairs] * np.uint64(3) + words[pairs + 1]),
                shapes,
                mix(shapes[pairs] * np.uint64(5) + shapes[pairs + 1]),
                mix(again + np.uint64(7)),
            ]
        )
    owner = np.concatenate([rows, rows[pairs], rows, rows[pairs], rows[pairs]])
    key = (owner << bits) | (keys >> np.uint64(64 - bits)).astype(np.int64)
    unique, counts = np.unique(key, return_counts=True)
    places = (unique & ((1 << bits) - 1)).astype(np.int32)
    owners = unique >> bits
    bounds = np.searchsorted(owners, np.arange(len(offsets)))
    values = np.log1p(counts)
    length = np.sqrt(sum_rows(values * values, bounds))
    return bounds, places, (values / length[owners]).astype(np.float32)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def train(texts: list[str], labels: np.ndarray, options: QualityOptions) -> tuple[np.ndarray, float]:
    """Weights and intercept after ``epochs`` passes, one example at a time, in a fixed shuffled order."""
    size = 1 << options.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    if len(texts) == 0 or labels.min() == labels.max():
        return np.zeros(size, np.float32), 0.0 if len(texts) == 0 else float(np.sign(labels[0] - 0.5) * 4)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for begin in range(0, len(texts), 200):
        bounds, places, values = vectors(pa.array(texts[begin : begin + 200], pa.large_string()), options.bits)
        rows += [
            (np.append(places[a:b], size), np.append(values[a:b], np.float32(1)))
            for a, b in zip(bounds[:-1], bounds[1:])
        ]
    random = np.random.default_rng(7)

    def weights(zi: np.ndarray, ni: np.ndarray, at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size, 0.0, options.l1)
        w = -(zi - np.sign(zi) * l1) / ((options.beta + np.sqrt(ni)) / options.alpha + options.l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(options.epochs):
        for i in random.permutation(len(rows)):
            at, x = rows[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni, at)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30))) - labels[i]) * x
            g2 = ni + g * g
            z[at] = zi + g - (np.sqrt(g2) - np.sqrt(ni)) / options.alpha * w
            n[at] = g2
    w = weights(z, n, np.arange(size + 1))
    return w[:size].astype(np.float32), float(w[size])


def score_texts(texts: pa.Array, weights: np.ndarray, intercept: float, bits: int) -> np.ndarray:
    bounds, places, values = vectors(texts, bits)
    return logistic(sum_rows(weights[places] * values, bounds) + intercept)


def quality_scores(docs: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.  One pass, no shuffle."""
    sample = labelled_sample(
        docs, labels, "quality", options.modulus, options.remainder, options.max_rows, options.max_chars
    )
    spark = docs.sparkSession
    model = train(sample["text"].tolist(), sample["label"].to_numpy(dtype=np.float64), options)
    shared = share(spark, model)  # 2**bits floats, whatever the input
    bits, threshold = options.bits, options.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared()
        for piece in pieces(batches):
            scores = score_texts(text_column(piece), weights, intercept, bits)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(scores),
                 pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = texts_of(docs).withColumn("held_out", held_out(F.col("doc_id"), options.modulus, options.remainder))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

