"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts (null: empty) are lower-cased (A-Z) and cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words
``[^\\x20\\x09]+``.  A task lays the words of many texts end to end with one space between them and keeps the prefix
polynomials of these bytes modulo 2^64, so the fingerprint of any run of words is one subtraction and one product.

1. Fingerprints are counted level by level: pairs, runs of three words, and so on.  A run is frequent only if its parts
   are, so each pass counts only runs whose parts passed the one before.  What is frequent goes to the tasks as a
   bitmap of bounded size: a false hit is counted in vain and dropped later, and a crowded bitmap only spares less work.
2. One more pass verifies the frequent fingerprints against the text: within a task all occurrences of a fingerprint
   are compared word by word, and the shuffle adds them up by the phrase itself, with a pointer to the first document
   that holds it.  Phrases that share a fingerprint part here, so counts are exact; only frequent phrases, and the
   words of frequent pairs, are ever materialised.
3. Joins score each candidate by its weakest cut and drop those that a longer phrase covers.

All counts are per language (null: ``und``).  Rows that repeat are counted each.  Null and empty texts have no words.
An empty table gives no rows.  A text of any length is taken in blocks of bytes that overlap by a few words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointgate.llm.text import kept_in_worker, materialise, mix, prepare, share


@dataclass(frozen=True)
class PhraseOptions:
    longest: int = 4  # at least 3
    least: int = 30
    top: int = 2000
    #: A phrase is dropped if a longer one holds it with at least this share (percent) of its occurrences.
    covered: int = 80
    #: Bits of a fingerprint as it is counted; those that collide are told apart by the text.
    print_bits: int = 40
    #: The bitmap has at least 16 bits a fingerprint, but never more than 2 to this power (28: 32 MB).
    bitmap_bits: int = 28
    block_bytes: int = 2 << 20


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse."""

    def row(base: int) -> np.ndarray:
        out = np.full(count, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return row(BASE), row(pow(BASE, -1, 1 << 64))


def _powers_for(count: int, options: PhraseOptions) -> tuple[np.ndarray, np.ndarray]:
    usual = options.block_bytes * 5 // 4
    if count > usual:  # words of megabytes
        return powers(count)
    return kept_in_worker(f"powers-{usual}", lambda: powers(usual))


class Block:
    """Words of some texts: their places, pieces, owners, and the fingerprint of any run of them."""

    def __init__(self, raw: np.ndarray, fresh: int, options: PhraseOptions):
        """``raw`` ends outside a word; runs whose last word begins before ``fresh`` were counted before."""
        kind = _KIND[raw]
        word = kind == 0
        edge = np.diff(word.astype(np.int8), prepend=0)
        self.starts = np.flatnonzero(edge == 1)
        ends = np.flatnonzero(edge == -1)
        low = _LOWER[raw]
        low[ends] = 0x20
        keep = word
        keep[ends] = True
        self.bytes = low[keep]  # each word with one space behind it
        after = np.cumsum(ends - self.starts + 1)
        self.begin = np.concatenate([[0], after])[:-1].astype(np.int64)
        self.end = after - 1
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        self.fresh = self.starts >= fresh
        forth, self.back = _powers_for(len(self.bytes) + 1, options)
        self.mask = np.uint64((1 << options.print_bits) - 1)
        self.prefix = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum(_BYTES[self.bytes] * forth[: len(self.bytes)], out=self.prefix[1:])

    def runs(self, size: int, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all runs of ``size`` words, and which lie in one piece and end in a fresh word."""
        count = max(0, len(self.begin) - size + 1)
        last = slice(size - 1, size - 1 + count)
        begin = self.begin[:count]
        value = (self.prefix[self.end[last]] - self.prefix[begin]) * self.back[begin]
        whole = (self.piece[:count] == self.piece[last]) & self.fresh[last]
        return mix(value + salt[:count]) & self.mask, whole


def blocks(data: np.ndarray, options: PhraseOptions) -> Iterator[tuple[int, int, int]]:
    """Begin, end and first fresh byte of overlapping blocks; every block ends outside a word."""
    at = fresh = 0
    while fresh < len(data):
        end = fresh + options.block_bytes
        while end < len(data) and _KIND[data[end - 1]] == 0:
            end += 1
        end = min(end, len(data))
        yield at, end, fresh
        fresh = end
        # the words before the border, as many as a run may need
        at, words = end, 0
        while at > 0 and words < options.longest - 1:
            at -= 1
            while at > 0 and _KIND[data[at]] != 0:
                at -= 1
            while at > 0 and _KIND[data[at - 1]] == 0:
                at -= 1
            words += 1


def joined(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a batch with a line end behind each, as bytes, and where each begins."""
    texts = [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), np.cumsum(sizes) - sizes


class Bitmap:
    """A set of fingerprints that may hold a few more than were put in."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(64 * len(bits) - 1)

    def holds(self, prints: np.ndarray) -> np.ndarray:
        place = prints & self.mask
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def candidates(block: Block, salt: np.ndarray, known: list[Bitmap], size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and fingerprints of the fresh runs of ``size`` words whose parts are frequent (by the last level)."""
    prints, may = block.runs(size, salt)
    if known:
        good = known[-1].holds(block.runs(size - 1, salt)[0])
        may = may & good[: len(may)] & good[1 : 1 + len(may)]
    first = np.flatnonzero(may)
    return first, prints[first]


def _lang_salt(langs: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")) for lang in langs], np.uint64)


def _blocks_of(batch: pa.RecordBatch, options: PhraseOptions):
    """Blocks of a batch with the language salt and the text of each word."""
    data, begins = joined(batch)
    salts = _lang_salt(batch.column("lang").to_pylist())
    for a, b, fresh in blocks(data, options):
        block = Block(data[a:b], fresh - a, options)
        if len(block.starts) == 0:
            continue
        text = np.searchsorted(begins, block.starts + a, side="right") - 1
        yield block, salts[text], text


def _rows(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )


def frequent_prints(rows: DataFrame, known: list, size: int, options: PhraseOptions) -> DataFrame:
    """Fingerprints of runs of ``size`` words with at least ``least`` occurrences.

    With runs of three come the words of frequent pairs, whose counts the scores need.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [Bitmap(k()) for k in known]
        for batch in batches:
            for block, salt, _ in _blocks_of(batch, options):
                yield _counted(candidates(block, salt, maps, size)[1])
                if size == 3:
                    pairs, whole = block.runs(2, salt)
                    first = np.flatnonzero(whole & maps[-1].holds(pairs))
                    words, _ = block.runs(1, salt)
                    yield _counted(words[np.union1d(first, first + 1)], options.least)

    return (
        rows.mapInArrow(run, "print long, n long")
        .groupBy("print").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= options.least).select("print")
    )


def _counted(prints: np.ndarray, times: int = 0) -> pa.RecordBatch:
    """Distinct fingerprints, each with its number here or with ``times``."""
    value, counts = np.unique(prints, return_counts=True)
    if times:
        counts = np.full(len(value), times)
    return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(counts, pa.int64())], ["print", "n"])


def bitmap_of(prints: DataFrame, options: PhraseOptions):
    """The fingerprints as a bitmap, shared with the tasks."""
    prints = materialise(prints, "prints")
    exponent = min(options.bitmap_bits, max(6, (16 * prints.count()).bit_length()))
    place = F.col("print").bitwiseAND((1 << exponent) - 1)
    found = (
        prints.select(F.shiftright(place, 6).alias("slot"), F.expr("shiftleft(1L, cast(print & 63 as int))").alias("bit"))
        .groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    bits = np.zeros(1 << (exponent - 6), np.uint64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return share(prints.sparkSession, bits)


def verified(rows: DataFrame, known: list, options: PhraseOptions) -> DataFrame:
    """lang, phrase (null: all words), f and first_doc of every run that seems frequent, and of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # by size of run; the words came with the runs of three
        maps = [Bitmap(k()) for k in (known[min(1, len(known) - 1)], *known)]
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            ids = batch.column("doc_id")
            for block, salt, text in _blocks_of(batch, options):
                spans = np.append(block.begin, len(block.bytes))
                words = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(block.begin),
                    [None, pa.py_buffer(spans), pa.py_buffer(block.bytes)],
                )
                codes = words.dictionary_encode().indices.to_numpy()
                data = block.bytes.tobytes()
                for lang, times in tokens_by_lang(langs, text[block.fresh]):
                    yield _batch([lang], [None], [times], [None])
                for size, seen in enumerate(maps, 1):
                    prints, whole = block.runs(size, salt)
                    first = np.flatnonzero(whole & seen.holds(prints))
                    if not len(first):
                        continue
                    prints = prints[first]
                    _, lead, group, times = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
                    head = first[lead][group]
                    same = langs_equal(langs, text[head], text[first])
                    for shift in range(size):
                        same &= codes[first + shift] == codes[head + shift]
                    if not same.all():  # fingerprints that collide: these occurrences are counted by themselves
                        odd = np.flatnonzero(~same)
                        times = np.bincount(group[same], minlength=len(lead))
                        lead, times = np.append(lead, odd), np.append(times, np.ones(len(odd), np.int64))
                    at = first[lead]
                    phrases = [data[p:q] for p, q in zip(block.begin[at].tolist(), block.end[at + size - 1].tolist())]
                    owner = text[at]
                    yield _batch([langs[k] for k in owner.tolist()], phrases, times, ids.take(pa.array(owner)))

    return (
        rows.mapInArrow(run, "lang string, phrase string, f long, doc_id long")
        .groupBy("lang", "phrase")
        .agg(F.sum("f").alias("f"), F.min("doc_id").alias("first_doc"))
    )


def langs_equal(langs: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    _, code = np.unique(np.array(langs, object), return_inverse=True)
    return code[a] == code[b]


def tokens_by_lang(langs: list[str], text: np.ndarray) -> Iterator[tuple[str, int]]:
    total: dict[str, int] = {}
    for k, times in enumerate(np.bincount(text, minlength=len(langs)).tolist()):
        if times:
            total[langs[k]] = total.get(langs[k], 0) + times
    yield from total.items()


def _batch(langs, phrases, times, ids) -> pa.RecordBatch:
    phrase = pa.array(phrases, pa.binary()).view(pa.string())
    ids = ids if isinstance(ids, pa.Array) else pa.array(ids, pa.int64())
    columns = [pa.array(langs, pa.string()), phrase, pa.array(times, pa.int64()), ids]
    return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f", "doc_id"])


def phrases(docs: DataFrame, options: PhraseOptions = PhraseOptions()) -> DataFrame:
    """Every run of 2 to ``longest`` words with at least ``least`` occurrences, and their words: lang, phrase, words, f,
    first_doc.

    Rows without a phrase hold the number of all words of a language.  Written to the shared folder.
    """
    rows = _rows(docs)
    known: list = []
    for size in range(2, options.longest + 1):
        known.append(bitmap_of(frequent_prints(rows, known[-1:], size, options), options))
    found = verified(rows, known, options)
    frequent_only = F.col("phrase").isNull() | (F.col("f") >= options.least)
    words = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1
    return materialise(found.where(frequent_only).withColumn("words", words), "phrases")


def _exact(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def scored(found: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of phrases of two words and more, by the weakest cut (ties: the first)."""
    whole = found.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = (
        whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("tail", F.expr("substr(phrase, length(head) + 2)"))
    )
    part = found.where("phrase is not null").select("lang", F.col("phrase").alias("part"), "f")
    both = cuts.join(part.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"]).join(
        part.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]
    )
    score = F.expr("(2000000 * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "a").agg(least).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
    )


def covering(found: DataFrame) -> DataFrame:
    """lang, phrase and the count of the commonest longer phrase that holds it."""
    longer = found.where("words >= 3").select("lang", "f", "words", F.split("phrase", " ").alias("parts"))
    spans = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn(
        "from", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1))
    )
    inside = spans.select("lang", "f", F.array_join(F.slice("parts", F.col("from"), F.col("size")), " ").alias("phrase"))
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, options: PhraseOptions = PhraseOptions()) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score, first_doc."""
    found = phrases(docs, options)
    totals = found.where("phrase is null").select("lang", F.col("f").alias("n"))
    covered = F.col("longer").isNotNull() & (_exact("longer") * 100 >= _exact("a") * options.covered)
    kept = scored(found).join(covering(found), ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= options.top)
    place = found.where("words >= 2").select("lang", "phrase", "first_doc")
    return best.join(totals, "lang").join(place, ["lang", "phrase"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_doc"
    )
