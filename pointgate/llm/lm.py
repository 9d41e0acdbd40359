"""LM scoring: log10 probabilities of whole texts under a log-bilinear neural model, and a counted base.

A text is its words between ASCII white space, A-Z in lower case, and one end token.  Every token belongs to one of a
fixed number of classes: the most frequent tokens are a class each, all others share classes by their last two
characters.  ``P(token) = P(class | two classes before) * P(token | class)``: the first factor is the neural model,
normalised over the classes; the second is ``(c + 1) / (tokens + distinct + 1)`` within the class, one part being
left for tokens never seen.  The probabilities of all tokens add up to one.

What is learned covers all training documents: token counts, class counts and counts of class triples are summed by
Spark, and every fitting step takes its gradient over all counted triples.  The driver sees the triples (at most ``classes ** 3``) and one row per class, whatever the input.

Counts reach the texts by chunks: texts are dealt into chunks by a hash, each chunk asks once for each of its
distinct tokens, and counts and texts of a chunk meet again in one task.  A token that every text holds is one row
per chunk.

Null and empty texts are the end token alone.  Rows without ``doc_id`` are scored, never learned from.  Repeated rows
are scored each.  Without training documents base and score are those of a single unknown token class: log10 of one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointgate.llm.logbilinear import LogBilinear
from pointgate.llm.text import fold, fresh, held_out, materialise, partitions_for, pieces, row_of, share, split_words
from pointgate.llm.text import sum_rows, text_column, texts_of


@dataclass(frozen=True)
class LmOptions:
    frequent: int = 95
    shared: int = 31
    width: int = 32
    steps: int = 500
    chunk_chars: int = 8_000_000
    modulus: int = 7
    remainder: int = 2

    @property
    def classes(self) -> int:
        """Frequent tokens, the end token, shared classes, and the mark before a text."""
        return self.frequent + 1 + self.shared + 1

    @property
    def end(self) -> int:
        return self.frequent

    @property
    def before(self) -> int:
        return self.classes - 1


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """As ``split_words``, after A-Z became a-z."""
    return split_words(pc.ascii_lower(fresh(texts)))


def shared_class(token: str, options: LmOptions) -> int:
    """The class of a token that is not frequent; the same hash as Spark's."""
    return options.frequent + 1 + xxhash.xxh64_intdigest(token[-2:].encode("utf-8"), 42) % (1 << 31) % options.shared


def class_codes(distinct: list[str], frequent: dict[str, int], options: LmOptions) -> np.ndarray:
    get = frequent.get
    found = (c if (c := get(t)) is not None else shared_class(t, options) for t in distinct)
    return np.fromiter(found, np.int64, len(distinct))


def with_ends(offsets: np.ndarray, codes: np.ndarray, options: LmOptions) -> tuple[np.ndarray, np.ndarray]:
    """Classes with the end token after every text."""
    return offsets + np.arange(len(offsets)), np.insert(codes, offsets[1:], options.end)


def contexts(offsets: np.ndarray, codes: np.ndarray, options: LmOptions) -> np.ndarray:
    """The two classes before each token as one number; the mark stands before a text."""
    place = np.arange(len(codes)) - offsets[row_of(offsets)]
    padded = np.concatenate([[options.before, options.before], codes])
    one = np.where(place >= 1, padded[1:-1], options.before)
    two = np.where(place >= 2, padded[:-2], options.before)
    return two * options.classes + one


@dataclass
class Model:
    options: LmOptions
    frequent: dict[str, int]
    table: np.ndarray | None  # log10 P(class | context), made where it is used
    class_totals: np.ndarray  # tokens + distinct + 1 per class; 1 for classes of one token
    tokens: int
    distinct: int

    def score(
        self, offsets: np.ndarray, codes: np.ndarray, distinct: list[str], counts: np.ndarray, ends: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens, known tokens, base and model log10 probability.  ``counts``: per distinct word."""
        o = self.options
        classes = class_codes(distinct, self.frequent, o)
        single = classes <= o.frequent
        total = float(self.tokens + self.distinct + 1)
        base = np.append(np.log10((counts + 1) / total), np.log10((ends + 1) / total))
        inside = np.where(single, 0.0, np.log10((counts + 1) / self.class_totals[classes]))
        inside = np.append(inside, 0.0)
        known = np.append(counts > 0, ends > 0)
        bounds, words = offsets + np.arange(len(offsets)), np.insert(codes, offsets[1:], len(distinct))
        coded = np.append(classes, o.end)[words]
        if self.tokens:
            step = self.table.reshape(-1, o.classes)[contexts(bounds, coded, o), coded]
        else:
            step, inside = np.zeros(len(coded)), np.zeros_like(inside)
        return (
            np.diff(bounds),
            sum_rows(known[words].astype(np.int64), bounds).astype(np.int64),
            sum_rows(base[words], bounds),
            sum_rows(step + inside[words], bounds),
        )


def by_chunk(rows: DataFrame, chunks: int) -> DataFrame:
    """As many partitions as chunks, at least: a task holds a few chunks, however many there are."""
    return rows.repartition(partitions_for(rows.sparkSession, chunks), "chunk")


def token_counts(chunked: DataFrame, chunks: int) -> DataFrame:
    """chunk, token and the token's count in the training documents, for every distinct token of every chunk."""

    def run(table: pa.Table) -> pa.Table:
        offsets, codes, distinct = tokens_of(pc.fill_null(joined(table.column("text")), ""))
        learned = np.repeat(table.column("learned").to_numpy(), np.diff(offsets))
        present = np.bincount(codes, minlength=len(distinct)) > 0
        count = np.bincount(codes[learned], minlength=len(distinct))
        chunk = table.column("chunk")[0].as_py()
        return pa.table(
            {
                "chunk": pa.array(np.full(int(present.sum()), chunk, np.int32)),
                "token": pa.array(distinct, pa.string()).filter(pa.array(present)),
                "n": pa.array(count[present].astype(np.int64)),
            }
        )

    chunked = by_chunk(chunked, chunks)
    asked = materialise(chunked.groupBy("chunk").applyInArrow(run, "chunk int, token string, n long"), "lm-tokens")
    return asked


def joined(column: pa.ChunkedArray) -> pa.Array:
    return column.cast(pa.large_string()).combine_chunks()


def class_triples(docs: DataFrame, frequent: dict[str, int], options: LmOptions) -> DataFrame:
    """Counts of (two classes before, class) over the training documents; a task sums before it sends."""
    shared = share(docs.sparkSession, frequent)
    size = options.classes**3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for piece in pieces(batches):
            offsets, codes, distinct = tokens_of(text_column(piece))
            classes = class_codes(distinct, shared(), options)[codes]
            bounds, classes = with_ends(offsets, classes, options)
            total += np.bincount(contexts(bounds, classes, options) * options.classes + classes, minlength=size)
        found = np.flatnonzero(total)
        for begin in range(0, len(found), 100_000):
            part = found[begin : begin + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["triple", "n"])

    return docs.mapInArrow(run, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n"))


def lm_scores(docs: DataFrame, options: LmOptions = LmOptions()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    spark = docs.sparkSession
    rows = texts_of(docs).select(
        "doc_id",
        "text",
        held_out(F.col("doc_id"), options.modulus, options.remainder).alias("held_out"),
        F.coalesce(fold(F.col("doc_id"), options.modulus) != options.remainder, F.lit(False)).alias("learned"),
    )
    size, documents = rows.agg(
        F.coalesce(F.sum(F.length("text")), F.lit(0)), F.coalesce(F.sum(F.col("learned").cast("long")), F.lit(0))
    ).first()
    chunks = max(1, -(-size // options.chunk_chars))
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    asked = token_counts(chunked, chunks)
    counts = materialise(asked.groupBy("token").agg(F.sum("n").alias("c")).where("c > 0"), "lm-counts")

    top = counts.orderBy(F.col("c").desc(), "token").limit(options.frequent).select("token").collect()
    frequent = {row["token"]: k for k, row in enumerate(top)}
    by_class = counts.join(F.broadcast(spark.createDataFrame([(t,) for t in frequent], "token string")), "token", "left_anti")
    key = F.pmod(F.xxhash64(F.expr("right(token, 2)")), F.lit(1 << 31)) % options.shared + options.frequent + 1
    sums = by_class.groupBy(key.cast("int").alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    totals = np.ones(options.classes)
    for row in sums:
        totals[row["k"]] += row["c"] + row["v"]
    all_tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = int(all_tokens + documents), int(distinct + (documents > 0))

    triples = class_triples(rows.where("learned").select("text"), frequent, options).toPandas()
    triples = triples.sort_values("triple")
    code = triples["triple"].to_numpy(dtype=np.int64)
    parts = np.stack([code // options.classes**2, code // options.classes % options.classes, code % options.classes], 1)
    network = LogBilinear(options.classes, options.width).fit(parts, triples["n"].to_numpy(), options.steps)
    allowed = np.arange(options.classes) != options.before
    allowed[len(frequent) : options.frequent] = False
    model = Model(options, frequent, None, totals, tokens, distinct)
    shared = share(spark, (model, network, allowed))  # a size set by the options alone
    ends = int(documents)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model, network, allowed = shared()
        if model.table is None:  # once per worker
            model.table = network.log_table(allowed)
        offsets, codes, distinct = tokens_of(pc.fill_null(joined(left.column("text")), ""))
        at = pc.index_in(pa.array(distinct, pa.large_string()), value_set=joined(right.column("token")))
        found = pc.fill_null(pc.take(right.column("c").combine_chunks(), at), 0).to_numpy(zero_copy_only=False)
        n, known, base, score = model.score(offsets, codes, distinct, found.astype(np.float64), ends)
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "held_out": left.column("held_out"),
                "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array(np.full(len(n), tokens, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    answers = by_chunk(asked.select("chunk", "token").join(counts, "token"), chunks)
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    texts = by_chunk(chunked.select("chunk", "doc_id", "held_out", "text"), chunks)
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
