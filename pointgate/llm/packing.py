"""Packing along a space-filling curve: documents to full training sequences, neighbours next to each other.

A document's tokens are hashed to random directions in a few dimensions; their sum, weighted by the logarithm of the
counts and brought to length one, is a point whose place along a Hilbert curve is the sort key.  Documents are
range-sorted by it, so similar texts follow each other, and laid end to end; every ``length`` tokens a new sequence
begins.  All sequences are full but the rest at the very end, which is cut into pieces of powers of two: nothing is
padded.

A document's tokens are its ids from the given tokenizer file and one end id.  A null or empty text is the end id
alone.  Rows that repeat an id are packed each.  Ties on the curve are ordered by ``doc_id`` and text hash, so a
group of copies spans as many partitions as it needs.  An empty table gives no pieces.

The tokenizer must drop white space and set letters apart from marks, as word-level BPE files do; then equal words
have equal ids everywhere and each distinct word is encoded once.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointgate.llm.hilbert import hilbert_keys
from pointgate.llm.text import joined_bytes, kept_in_worker, materialise, mix, partitions_for, pieces, row_of, share
from pointgate.llm.text import sum_rows, text_column, texts_of, word_hashes, word_spans


@dataclass(frozen=True)
class PackOptions:
    length: int = 2048
    end_id: int = 1
    dimensions: int = 4
    bits: int = 12
    cache_words: int = 300_000
    piece_bytes: int = 4 << 20


def directions(count: int, dimensions: int) -> np.ndarray:
    """A fixed random direction for each token id."""
    shifts = (np.arange(dimensions, dtype=np.uint64) * np.uint64(16))[None, :]
    hashes = mix(np.arange(1, count + 1, dtype=np.uint64))
    return ((hashes[:, None] >> shifts) & np.uint64(0xFFFF)).astype(np.float64) / 32768.0 - 1.0


def curve_keys(bounds: np.ndarray, ids: np.ndarray, table: np.ndarray, options: PackOptions) -> np.ndarray:
    """The place of each text along the curve."""
    pair, times = np.unique(row_of(bounds) * len(table) + ids, return_counts=True)
    owner, token = pair // len(table), pair % len(table)
    weight = np.log1p(times)
    edges = np.searchsorted(owner, np.arange(len(bounds)))
    total = sum_rows(table[token] * weight[:, None], edges)
    size = np.sqrt(sum_rows(weight * weight, edges))
    # each coordinate has variance 1/3 when tokens are random: its normal distribution function spreads it evenly
    z = total / np.maximum(size, 1e-9)[:, None] * np.sqrt(3.0)
    even = 1.0 / (1.0 + np.exp(-1.702 * z))
    grid = np.minimum((even * (1 << options.bits)).astype(np.int64), (1 << options.bits) - 1)
    return hilbert_keys(grid, options.bits)


#: Closing marks that the tokenizer always sets apart from the letters before them.
MARKS = ".,;:!?"
#: Letters below U+0250 (but U+0130, which folds to two code points): words of them alone are one word to the tokenizer.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"


class WordTokens:
    """Token ids by distinct words: white space never joins tokens here, so equal words have equal ids.

    Words seen lately are kept in sorted arrays, by 64-bit hash and length: about 40 bytes a word, ``cache_words`` at
    most; the longest unused half goes when they are full.  Only words not kept are made to strings.
    """

    def __init__(self, definition: str, options: PackOptions):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.tokenizer = Tokenizer.from_str(definition)
        self.full = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        # for words of letters alone, without the steps that change nothing for them
        self.lean = (
            normalizers.Lowercase(),
            pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            ),
        )
        self.table = directions(self.tokenizer.get_vocab_size(with_added_tokens=True) + 2, options.dimensions)
        self.closes = np.zeros(len(self.table), bool)  # tokens that end a word
        self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        marks = [e.ids for e in self.encode(list(MARKS))]
        self.single = all(len(m) == 1 for m in marks)
        self.marks = np.array([0, *(m[0] for m in marks)], "<u4")
        self.limit, self.clock = options.cache_words, 0
        self.keys, self.flat = np.zeros(0, np.uint64), np.zeros(0, "<u4")
        self.starts = self.sizes = self.seen = np.zeros(0, np.int32)

    def encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def words(self, bodies: list[str]) -> Iterator[bytes]:
        """Ids of words made of letters: each is one word to the tokenizer, so many go in one text."""
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.lean
        try:
            texts = [" ".join(bodies[k : k + 500]) for k in range(0, len(bodies), 500)]
            made = [np.array(e.ids, "<u4") for e in self.encode(texts)]
        finally:
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.full
        for k, ids in enumerate(made):
            part = bodies[500 * k : 500 * k + 500]
            edges = np.append(0, np.flatnonzero(self.closes[ids]) + 1)
            if len(edges) != len(part) + 1:  # a vocabulary without word ends
                yield from (np.array(e.ids, "<u4").tobytes() for e in self.encode(part))
                continue
            raw = ids.tobytes()
            yield from (raw[4 * a : 4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()))

    def encoded(self, bodies: list[str], plain: list[bool]) -> list[bytes]:
        found: list[bytes] = [b""] * len(bodies)
        easy = [k for k, p in enumerate(plain) if p]
        odd = [k for k, p in enumerate(plain) if not p]
        for k, ids in zip(easy, self.words([bodies[k] for k in easy])):
            found[k] = ids
        for k, made in zip(odd, self.encode([bodies[k] for k in odd])):
            found[k] = np.array(made.ids, "<u4").tobytes()
        return found

    def ids(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ragged rows of ids, one for each word: offsets and ids.

        Letters are encoded without their closing mark and with A-Z folded, as the tokenizer does itself; anything
        unusual goes to the tokenizer as it is.
        """
        words = pa.array(distinct, pa.large_string())
        bare = pc.ascii_rtrim(words, characters=MARKS)
        cut = pc.subtract(pc.binary_length(words), pc.binary_length(bare)).to_numpy(zero_copy_only=False)
        plain = pc.match_substring_regex(bare, LETTERS).to_numpy(zero_copy_only=False) & (cut <= int(self.single))
        coded = pc.if_else(pa.array(plain), pc.ascii_lower(bare), words).dictionary_encode()
        body = coded.indices.to_numpy(zero_copy_only=False)
        bodies = coded.dictionary.to_pylist()
        easy = np.zeros(len(bodies), bool)
        easy[body] = plain
        encoded = self.encoded(bodies, easy.tolist())
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        marked = plain & (cut == 1)
        bounds = np.concatenate([[0], np.cumsum(sizes[body] + marked)])
        out = np.empty(int(bounds[-1]), "<u4")
        flat = np.frombuffer(b"".join(encoded), "<u4")
        into = ragged(bounds[:-1], sizes[body])
        out[into] = flat[ragged((np.cumsum(sizes) - sizes)[body], sizes[body])]
        last = pc.utf8_slice_codeunits(words.filter(pa.array(marked)), -1)
        mark = pc.index_in(last, value_set=pa.array(list(MARKS), pa.large_string())).to_numpy(zero_copy_only=False)
        out[bounds[1:][marked] - 1] = self.marks[mark + 1]
        return bounds, out

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's ids begin in ``flat``, and how many they are; words not kept are encoded now."""
        hashes = word_hashes(data, starts, ends)
        # the length is part of the key
        hashes ^= (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        keys, first, code = np.unique(hashes, return_index=True, return_inverse=True)
        self.clock += 1
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        self.seen[at[hit]] = self.clock
        new = np.flatnonzero(~hit)
        if len(new):
            self.make_room(len(new))
            raw = data.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            bounds, ids = self.ids([raw[a:b].decode("utf-8", "replace") for a, b in spans])
            order = np.argsort(np.concatenate([self.keys, keys[new]]), kind="stable")
            base = len(self.flat)
            self.flat = np.concatenate([self.flat, ids])
            self.keys = np.concatenate([self.keys, keys[new]])[order]
            self.starts = np.concatenate([self.starts, base + bounds[:-1]]).astype(np.int32)[order]
            self.sizes = np.concatenate([self.sizes, np.diff(bounds)]).astype(np.int32)[order]
            self.seen = np.concatenate([self.seen, np.full(len(new), self.clock)]).astype(np.int32)[order]
        at = np.searchsorted(self.keys, keys)
        return self.starts[at][code], self.sizes[at][code]

    def make_room(self, count: int) -> None:
        """Drop the longest unused words, but none of the present texts."""
        if len(self.keys) + count <= self.limit:
            return
        kept = np.argsort(-self.seen, kind="stable")[: self.limit // 2]
        kept = np.sort(np.union1d(kept, np.flatnonzero(self.seen == self.clock)))
        self.flat = self.flat[ragged(self.starts[kept], self.sizes[kept])]
        self.keys, self.seen, self.sizes = self.keys[kept], self.seen[kept], self.sizes[kept]
        self.starts = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each row, one row behind the other."""
    sizes = sizes.astype(np.int64)
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def token_rows(
    texts: pa.Array, words: WordTokens, options: PackOptions
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ragged rows of token ids with the end id, and the curve key of each text."""
    data, begins = joined_bytes(texts)
    starts, ends = word_spans(data)
    at, sizes = words.places(data, starts, ends)
    offsets = np.searchsorted(starts, np.append(begins, len(data)))  # the words of each text
    # the end id follows the words of every text
    flat = np.append(words.flat, np.uint32(options.end_id))
    at, sizes = np.insert(at, offsets[1:], len(flat) - 1), np.insert(sizes, offsets[1:], 1)
    ids = flat[ragged(at, sizes)]
    bounds = np.concatenate([[0], np.cumsum(sizes)])[offsets + np.arange(len(offsets))]
    return bounds, ids, curve_keys(bounds, ids, words.table, options)


def tokenized(docs: DataFrame, tokenizer: str, options: PackOptions) -> DataFrame:
    """doc_id, curve, tie, n and ids (32-bit little-endian; 16-bit on the way if they fit) of every row."""
    rows = texts_of(docs).withColumn("tie", F.xxhash64("text"))
    content = Path(tokenizer).read_text(encoding="utf-8")
    definition = share(rows.sparkSession, content)  # one file, fixed size
    name = f"words-{zlib.crc32(content.encode())}-{options}"  # one set of known words per worker

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_in_worker(name, lambda: WordTokens(definition(), options))
        for piece in pieces(batches, limit=options.piece_bytes):
            bounds, ids, keys = token_rows(text_column(piece), words, options)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(keys, pa.int64()),
                    piece.column("tie"),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([compact(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                ],
                ["doc_id", "curve", "tie", "n", "ids"],
            )

    made = rows.mapInArrow(run, "doc_id long, curve long, tie long, n long, ids binary")
    return materialise(made, "tokens")  # finding the ranges reads the rows once more than sorting does


def compact(ids: np.ndarray) -> bytes:
    return ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else ids.astype("<u4").tobytes()


def loose(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * count else "<u4").astype("<u4")


def laid_out(rows: DataFrame, options: PackOptions) -> DataFrame:
    """The rows in curve order with ``part`` and ``before``: the tokens ahead of a row in its partition; written once.

    Partitions are ranges of (curve, doc_id, tie), so neither a frequent key nor a group of copies stays in one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            counts = batch.column("n").to_numpy()
            ahead = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n"), batch.column("ids"),
                 pa.array(np.full(len(counts), part, np.int32)), pa.array(ahead, pa.int64())],
                ["doc_id", "n", "ids", "part", "before"],
            )

    order = ["curve", "doc_id", "tie"]
    ranged = rows.repartitionByRange(partitions_for(rows.sparkSession), *order).sortWithinPartitions(*order)
    return materialise(
        ranged.mapInArrow(run, "doc_id long, n long, ids binary, part int, before long"), "packing"
    )


def cuts(start: int, count: int, total: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Pieces of the tokens [start, start + count): begin, size, sequence, offset in it.

    Beyond the last full sequence the rest of ``total`` is cut at powers of two, largest first.
    """
    full = total // length
    at, end = start, start + count
    while at < end and at < full * length:
        sequence, offset = divmod(at, length)
        size = min(end - at, length - offset)
        yield at - start, size, sequence, offset
        at += size
    edge, sequence, rest = full * length, full, total - full * length
    while at < end:
        size = 1 << (rest.bit_length() - 1)
        if at < edge + size:
            taken = min(end, edge + size) - at
            yield at - start, taken, sequence, at - edge
            at += taken
        edge, sequence, rest = edge + size, sequence + 1, rest - size


def packed(docs: DataFrame, tokenizer: str, options: PackOptions = PackOptions(), with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids."""
    rows = laid_out(tokenized(docs, tokenizer, options), options)
    totals = rows.groupBy("part").agg(F.sum("n").alias("n"))  # as many rows as partitions
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy()).alias("total")
    )
    placed = rows.join(F.broadcast(bases), "part").select(
        "doc_id", "n", "ids", (F.col("base") + F.col("before")).alias("at"), "total"
    )
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, ...]] = []
            blobs: list[bytes] = []
            at, totals = batch.column("at").to_pylist(), batch.column("total").to_pylist()
            counts, docs = batch.column("n").to_pylist(), batch.column("doc_id").to_pylist()
            for k, data in enumerate(batch.column("ids")):
                ids = loose(data.as_py(), counts[k])
                for start, size, sequence, offset in cuts(at[k], counts[k], totals[k], options.length):
                    blob = ids[start : start + size].tobytes()
                    out.append((docs[k], start, size, zlib.crc32(blob), counts[k], sequence, offset))
                    if with_ids:
                        blobs.append(blob)
            if not out:
                continue
            arrays = [pa.array(c, pa.int64()) for c in zip(*out)]
            if with_ids:
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(blobs, pa.binary())], [*names, "ids"])
            else:
                yield pa.RecordBatch.from_arrays(arrays, names)

    return placed.mapInArrow(run, schema + (", ids binary" if with_ids else ""))
