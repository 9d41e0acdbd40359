"""Toxicity: a convolutional text classifier in numpy, with a threshold per language.

Words are embedded by hashing (the word and its first four, five and six letters, so that inflected forms share
places).  Filters of several widths slide over the words; the strongest answer of each filter, cut at zero, feeds
one logistic unit.  A filter's answer is a sum over its width of per-word products, so each distinct word of a piece
of text is multiplied once and the rest is gathering and adding.

Fitting uses every labelled row.  The rows are dealt to parts by a hash of their id; in each round every part takes
the common network, passes over its rows block by block, and sends back what it changed; Spark averages the changes by
place.  A fifth of the rows is set aside to choose, for each language, the threshold on the raw answer that separates
best, from counts of all their answers.  Scores are shifted so that a language's threshold lies at 0.5.  The language
is read from the text by rank-order profiles counted over all labelled rows; columns other than the text never enter.
Sums are of whole numbers, so the network does not depend on the order in which parts end.

Empty and null texts have no words and score by the bias alone.  Equal texts score equally.  Without labels of both
kinds every score is 0.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointgate.llm.langid import LangOptions, Profiles, learn_profiles, letter_table, letters
from pointgate.llm.samples import labelled_rows
from pointgate.llm.text import filtered, fresh, held_out, kept_in_worker, materialise, mix, pieces, share, split_words
from pointgate.llm.text import text_column, texts_of, word_hashes
from pointgate.session import scratch

#: Bytes of text scored at once: the answers of all filters at each word take some twenty times that.
SCORED_BYTES = 2 << 20
#: Parts send their weights as whole numbers of this size.
_STEP = 1 << 20
#: Answers are counted in bins of this width.
_BINS = 256


@dataclass(frozen=True)
class ToxicityOptions:
    bits: int = 17
    width: int = 16
    filters: int = 8
    spans: tuple[int, ...] = (1, 2, 3)
    epochs: int = 10
    rate: float = 0.1
    batch: int = 32
    positive_weight: float = 2.0
    threshold: float = 0.5
    language_rows: int = 15
    profile_size: int = 300
    least_epochs: int = 4
    passes: int = 2  # over a block, in each round
    max_rows: int = 4_000  # of a part; beyond max_parts parts they hold more
    max_parts: int = 256
    max_chars: int = 1_000_000  # of a block, as UTF-8 bytes; a longer text is a block of its own
    modulus: int = 5
    remainder: int = 0
    seed: int = 11


def bare(words: pa.Array) -> pa.Array:
    """Lower case, without marks around the words; a word of marks alone stays."""
    lower = pc.utf8_lower(words)
    inner = pc.replace_substring_regex(lower, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return pc.if_else(pc.equal(pc.binary_length(inner), 0), lower, inner)


def hashes_of(words: pa.Array, seed: int) -> np.ndarray:
    words = fresh(words)
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    return mix(word_hashes(data, offsets[:-1], offsets[1:]) + np.uint64(seed))


def places_of(distinct: list[str], bits: int) -> np.ndarray:
    """The four hashed places of each word."""
    if not distinct:
        return np.empty((0, 4), np.int64)
    words = bare(pa.array(distinct, pa.large_string()))
    cut = [words, *(pc.utf8_slice_codeunits(words, 0, n) for n in (4, 5, 6))]
    hashes = [hashes_of(part, seed) for seed, part in enumerate(cut, 1)]
    return (np.stack(hashes, axis=1) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Network:
    options: ToxicityOptions
    embeddings: np.ndarray
    filters: list[np.ndarray]  # per span: span x width x filters
    biases: np.ndarray
    output: np.ndarray
    output_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    common_threshold: float = 0.0
    profiles: Profiles | None = None

    @classmethod
    def new(cls, options: ToxicityOptions) -> Network:
        random = np.random.default_rng(options.seed)
        n = len(options.spans) * options.filters
        return cls(
            options,
            random.normal(0, 0.05, (1 << options.bits, options.width)).astype(np.float32),
            [random.normal(0, 0.3, (s, options.width, options.filters)).astype(np.float32) for s in options.spans],
            np.zeros(n, np.float32),
            np.abs(random.normal(0, 0.3, n)).astype(np.float32),
            -1.0,
        )

    def answers(self, places: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Per span, the filters' answers at each word.  Beyond the end of a text a word is all zeros."""
        vectors = self.embeddings[places[:, 0]]
        for column in range(1, places.shape[1]):
            vectors += self.embeddings[places[:, column]]
        ends = np.repeat(offsets[1:], np.diff(offsets))
        at = np.arange(len(codes))
        for k, weight in enumerate(self.filters):
            first = k * self.options.filters
            total = (vectors @ weight[0] + self.biases[first : first + self.options.filters])[codes]
            for step in range(1, weight.shape[0]):
                products = vectors @ weight[step]
                inside = np.flatnonzero(at + step < ends)
                total[inside] += products[codes[inside + step]]
            yield total

    def raw(self, texts: pa.Array) -> np.ndarray:
        offsets, codes, distinct = split_words(texts)
        pooled = np.zeros((len(offsets) - 1, len(self.output)), np.float32)
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            places = places_of(distinct, self.options.bits)
            for k, answer in enumerate(self.answers(places, codes, offsets)):
                first = k * self.options.filters
                best = np.maximum.reduceat(answer, offsets[full], axis=0)
                pooled[full, first : first + self.options.filters] = np.maximum(best, 0)
        return pooled @ self.output + self.output_bias

    def threshold_of(self, text: str, table: np.ndarray) -> float:
        if self.profiles is None or not self.thresholds:
            return self.common_threshold
        lang, _ = self.profiles.predict(letters(text, table))
        return self.thresholds.get(lang, self.common_threshold)

    def scores(self, texts: pa.Array, table: np.ndarray) -> np.ndarray:
        shift = np.array([self.threshold_of(t, table) for t in texts.to_pylist()], np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(texts).astype(np.float64) - shift, -30, 30)))


@dataclass
class Training:
    """A network and the sums of squared gradients that set the size of its steps."""

    network: Network
    places: np.ndarray
    filters: list[np.ndarray]
    biases: np.ndarray
    output: np.ndarray

    @classmethod
    def new(cls, options: ToxicityOptions) -> Training:
        net = Network.new(options)
        at_first = [np.full(x.shape, 1e-3, np.float32) for x in (net.embeddings[:, 0], *net.filters, net.biases, net.output)]
        return cls(net, at_first[0], at_first[1:-2], at_first[-2], at_first[-1])

    def _dense(self) -> list[np.ndarray]:
        """All but the embeddings."""
        net = self.network
        bias = np.array([net.output_bias], np.float32)
        return [*net.filters, net.biases, net.output, bias, *self.filters, self.biases, self.output]

    def rows(self) -> np.ndarray:
        """A row per place (its embedding, then its sum), then all other numbers in rows of the same width."""
        wide = self.network.options.width + 1
        flat = np.concatenate([x.ravel() for x in self._dense()])
        flat = np.concatenate([flat, np.zeros(-len(flat) % wide, np.float32)]).reshape(-1, wide)
        return np.concatenate([np.column_stack([self.network.embeddings, self.places]), flat])

    def take(self, at: np.ndarray, rows: np.ndarray) -> None:
        """Put back some of ``rows()``."""
        all_rows = self.rows()
        all_rows[at] = rows
        n, net = len(self.places), self.network
        net.embeddings, self.places = all_rows[:n, :-1].copy(), all_rows[:n, -1].copy()
        flat, done, parts = all_rows[n:].ravel(), 0, []
        for old in self._dense():
            parts.append(flat[done : done + old.size].reshape(old.shape).copy())
            done += old.size
        k = len(net.filters)
        net.filters, net.biases, net.output, net.output_bias = parts[:k], parts[k], parts[k + 1], float(parts[k + 2][0])
        self.filters, self.biases, self.output = parts[k + 3 : 2 * k + 3], parts[-2], parts[-1]

    def block(self, texts: pa.Array, labels: np.ndarray, random: np.random.Generator) -> None:
        """Stochastic gradient descent over a block, with per-place step sizes; only the strongest answers carry a
        gradient."""
        network, o = self.network, self.network.options
        offsets, codes, distinct = split_words(texts)
        places = places_of(distinct, o.bits)
        del distinct
        full = np.flatnonzero(np.diff(offsets))
        order = [random.permutation(full) for _ in range(o.passes)]
        for rows in (one[begin : begin + o.batch] for one in order for begin in range(0, len(one), o.batch)):
            lengths = offsets[rows + 1] - offsets[rows]
            own = np.concatenate([[0], np.cumsum(lengths)])
            taken = np.concatenate([codes[offsets[r] : offsets[r + 1]] for r in rows])
            words, local = np.unique(taken, return_inverse=True)
            marks = places[words]
            positions, pooled = [], []
            for answer in network.answers(marks, local, own):
                where = np.stack([a + answer[a:b].argmax(axis=0) for a, b in zip(own[:-1], own[1:])])
                positions.append(where)
                pooled.append(np.take_along_axis(answer, where, axis=0))
            top = np.maximum(np.concatenate(pooled, axis=1), 0)
            logit = top @ network.output + network.output_bias
            target = labels[rows]
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) * np.where(target > 0, o.positive_weight, 1)
            error = (error / len(rows)).astype(np.float32)
            back = error[:, None] * network.output * (top > 0)
            vectors = network.embeddings[marks].sum(axis=1)
            into = np.zeros_like(vectors)
            for k, weight in enumerate(network.filters):
                first = k * o.filters
                part = back[:, first : first + o.filters]
                change = np.zeros_like(weight)
                for step in range(weight.shape[0]):
                    at = positions[k] + step
                    inside = at < own[1:, None]
                    chosen = local[np.minimum(at, len(local) - 1)]
                    g = np.where(inside, part, 0)
                    change[step] = np.einsum("df,dfw->wf", g, vectors[chosen])
                    np.add.at(into, chosen.ravel(), (g[:, :, None] * weight[step].T[None]).reshape(-1, o.width))
                self.filters[k] += change * change
                network.filters[k] = weight - o.rate * change / np.sqrt(self.filters[k])
            change = back.sum(axis=0)
            self.biases += change * change
            network.biases -= o.rate * change / np.sqrt(self.biases)
            change = error @ top
            self.output += change * change
            network.output -= o.rate * change / np.sqrt(self.output)
            network.output_bias -= o.rate * float(error.sum())
            moved = np.flatnonzero(np.abs(into).sum(axis=1))
            for column in range(marks.shape[1]):
                at = marks[moved, column]
                np.add.at(self.places, at, (into[moved] ** 2).mean(axis=1))
                step = o.rate * into[moved] / np.sqrt(self.places[at])[:, None]
                np.add.at(network.embeddings, at, -step)


def _round(rows: DataFrame, training: Training, number: int) -> None:
    """One pass of every part over its rows, from the same start; then the mean, by place, of what parts changed."""
    options, wide = training.network.options, training.network.options.width + 1
    shared = share(rows.sparkSession, training)  # a size set by the options alone
    names = ["at", *[f"w{i}" for i in range(wide)]]

    def changed(own: Training) -> pa.RecordBatch:
        before, after = shared().rows(), own.rows()
        moved = (after != before).any(axis=1)
        moved[len(own.places) :] = True
        at = np.flatnonzero(moved)
        whole = np.clip(np.rint(after[at].astype(np.float64) * _STEP), -(2**31), 2**31 - 1).astype(np.int32)
        columns = [pa.array(np.ascontiguousarray(whole[:, i])) for i in range(wide)]
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = part = random = None
        for piece in pieces(batches, limit=options.max_chars):
            of = piece.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for begin, end in zip(cuts, cuts[1:]):
                if own is None or of[begin] != part:
                    if own is not None:
                        yield changed(own)
                    own, part = copy.deepcopy(shared()), int(of[begin])
                    random = np.random.default_rng([options.seed + 1, number, part])
                some = piece.slice(begin, end - begin)
                own.block(text_column(some), some.column("label").to_numpy().astype(np.float64), random)
        if own is not None:
            yield changed(own)

    sums = (
        rows.select("part", "text", "label")
        .mapInArrow(run, ", ".join(f"{name} int" for name in names))
        .groupBy("at")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in names[1:]])
        .toArrow()  # a row per place at most
    )
    total = np.column_stack([sums.column(name).to_numpy() for name in names[1:]])
    mean = total / sums.column("n").to_numpy()[:, None] / _STEP
    training.take(sums.column("at").to_numpy(), mean.astype(np.float32))


def best_threshold(value: np.ndarray, negative: np.ndarray, positive: np.ndarray) -> float:
    """The cut with the best balanced accuracy; in the widest such gap, a quarter of the way up from the negatives.

    ``value`` ascends; ``negative`` and ``positive`` count the rows of each label that have it.
    """
    good = np.concatenate([[0], np.cumsum(negative)]) / max(negative.sum(), 1) + (
        positive.sum() - np.concatenate([[0], np.cumsum(positive)])
    ) / max(positive.sum(), 1)
    edges = np.concatenate([[value[0] - 1], value, [value[-1] + 1]])
    gaps = np.where(good >= good.max() - 1e-12, edges[1:] - edges[:-1], -1)
    k = int(gaps.argmax())
    return float(edges[k] + (edges[k + 1] - edges[k]) / 4)


def _choose_thresholds(rows: DataFrame, network: Network) -> None:
    """Thresholds from the answers to all ``rows``, counted by language, bin and label."""
    shared = share(rows.sparkSession, network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_in_worker("letters", letter_table)
        for piece in pieces(batches, limit=SCORED_BYTES):
            texts = text_column(piece)
            named = [shared().profiles.predict(letters(t, table))[0] for t in texts.to_pylist()]
            bins = np.rint(np.clip(shared().raw(texts), -30, 30) * _BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(named, pa.string()), pa.array(bins), piece.column("label")], ["lang", "bin", "label"]
            )

    counted = rows.select("text", "label").mapInArrow(run, "lang string, bin int, label int")
    # at most 60 * _BINS bins a language
    found = counted.groupBy("lang", "bin").agg(
        F.count_if(F.col("label") == 0).alias("negative"), F.count_if(F.col("label") == 1).alias("positive")
    ).toPandas()

    def threshold(of) -> float:
        of = of.groupby("bin")[["negative", "positive"]].sum().sort_index()
        return best_threshold(of.index.to_numpy() / _BINS, of["negative"].to_numpy(), of["positive"].to_numpy())

    network.common_threshold = threshold(found)
    for lang, of in found.groupby("lang"):
        if min(of["negative"].sum(), of["positive"].sum()) >= network.options.language_rows:
            network.thresholds[str(lang)] = threshold(of)


def fitted(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> Network:
    """Fit on four fifths of the labelled rows, choose thresholds on the rest."""
    with scratch(docs.sparkSession):
        rows = labelled_rows(
            docs, labels, "toxic", options.modulus, options.remainder, options.max_rows, options.max_parts
        )
        rows = rows.withColumn("aside", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 4)
        rows = materialise(rows, "toxicity-rows", compression="zstd")
        counts = {(r["aside"], r["label"]): r["count"] for r in rows.groupBy("aside", "label").count().collect()}
        total = sum(counts.values())
        training = Training.new(options)
        network = training.network
        if total < 10 or len({label for _, label in counts}) < 2:
            network.output[:] = 0
            network.output_bias = -30.0
            return network
        split = len(counts) == 4
        learnt = rows.where("not aside") if split else rows
        # the fewer the rows, the more often each is seen
        epochs = min(options.epochs, max(options.least_epochs, math.ceil(options.epochs * options.max_rows / total)))
        rounds = math.ceil(epochs / options.passes)
        for number in range(rounds):
            _round(learnt, training, number)
        network.profiles = learn_profiles(
            rows, LangOptions(options.profile_size, options.modulus, options.remainder)
        )
        _choose_thresholds(rows.where("aside") if split else rows, network)
        return network


def toxicity_scores(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.  Scored in one pass, no shuffle."""
    shared = share(docs.sparkSession, fitted(docs, labels, options))  # a size set by the options alone
    threshold = options.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_in_worker("letters", letter_table)
        for piece in pieces(batches, limit=SCORED_BYTES):
            scores = shared().scores(text_column(piece), table)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(scores),
                 pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = texts_of(docs).withColumn("held_out", held_out(F.col("doc_id"), options.modulus, options.remainder))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> DataFrame:
    """``docs`` less the rows judged toxic; all columns stay as they are.  No shuffle: rows pass through the scorer."""
    shared = share(docs.sparkSession, fitted(docs, labels, options))
    threshold = options.threshold

    def clean(texts: pa.Array) -> np.ndarray:
        return shared().scores(texts, kept_in_worker("letters", letter_table)) < threshold

    return filtered(docs, clean, SCORED_BYTES)
