"""What the corpus operators share: reading texts, folds, bounded Arrow pieces, words, written tables.

Operators take any table with ``doc_id`` and ``text``.  Only these columns are read, so extra columns never clash.
A null text counts as empty; a row without ``doc_id`` is never learned from and is not held out.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.session import scratch_path, ship_package

#: Rows and bytes of an Arrow batch: memory of a Python worker does not follow the table.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20
#: Bytes of text that a kernel works on at once; a longer text is a piece of its own.
PIECE_BYTES = 6 << 20


def prepare(spark: SparkSession) -> None:
    """Send the package's task functions by value, and bound the Arrow batches of this session."""
    ship_package()
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and text alone; null texts become empty."""
    prepare(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(fold(doc_id, modulus) == F.lit(remainder), F.lit(False))


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs neither repeat it nor depend on executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def kept_in_worker(key: str, make: Callable[[], Any]) -> Any:
    """A value that later tasks of the same Python worker find again; the last three are kept."""
    store = sys.__dict__.setdefault("_pointgate_llm_kept", {})
    if key not in store:
        while len(store) >= 3:
            del store[next(iter(store))]
        store[key] = make()
    return store[key]


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value of bounded size; the function returned gives it in a task, unpacked once per worker.

    It is packed by value, so that workers need no installed copy of this package.
    """
    prepare(spark)
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    key = uuid.uuid4().hex
    return lambda: kept_in_worker(key, lambda: cloudpickle.loads(packed.value))


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text; a longer text comes alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The texts in buffers of their own: some string kernels misread a slice of a larger array."""
    return fresh(pc.fill_null(batch.column(name).cast(pa.large_string()), ""))


def fresh(texts: pa.Array) -> pa.Array:
    return pa.concat_arrays([texts, pa.array([], texts.type)])


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words between ASCII white space: offsets per text, a code per word, and the distinct words by code."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    distinct = encoded.dictionary.to_pylist()
    if "" in distinct:  # white space at either end
        keep = codes != distinct.index("")
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return offsets, codes, distinct


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts with a line end behind each, and where each text begins."""
    parts = texts.cast(pa.large_binary()).to_pylist()
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    return np.frombuffer(b"\n".join([*parts, b""]), np.uint8), np.cumsum(sizes) - sizes


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_HASH_BYTES = 1 << 20


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words between ASCII white space; the last byte is white space."""
    edge = np.diff((~_SPACE[data]).astype(np.int8), prepend=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rows = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        row = np.full(count, base, np.uint64)
        row[0] = 1
        rows.append(np.multiply.accumulate(row))
    return rows[0], rows[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, from prefix polynomials of their bytes; arrays follow a megabyte, not the text."""
    out = np.empty(len(starts), np.uint64)
    letters = mix(np.arange(1, 257, dtype=np.uint64))
    done = 0
    while done < len(starts):
        begin = int(starts[done])
        last = max(done + 1, int(np.searchsorted(ends, begin + _HASH_BYTES, side="right")))
        size = int(ends[last - 1]) - begin
        if size <= _HASH_BYTES:
            forth, back = kept_in_worker("powers", lambda: _powers(_HASH_BYTES + 1))
        else:  # one word longer than that
            forth, back = _powers(size + 1)
        prefix = np.zeros(size + 1, np.uint64)
        np.cumsum(letters[data[begin : begin + size]] * forth[:size], out=prefix[1:])
        a, b = starts[done:last] - begin, ends[done:last] - begin
        out[done:last] = (prefix[b] - prefix[a]) * back[a]
        done = last
    return mix(out)


def hash_words(distinct: list[str], seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w.encode("utf-8", "surrogatepass"), seed) for w in distinct), np.uint64, len(distinct))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For each element of ragged rows, its row."""
    return np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))


def sum_rows(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums over ragged rows; empty rows give zero."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), dtype=np.float64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full], axis=0, dtype=np.float64)
    return out


def filtered(docs: DataFrame, keep: Callable[[pa.Array], np.ndarray], limit: int = PIECE_BYTES) -> DataFrame:
    """The rows whose text (null: empty) ``keep`` accepts, with all columns whatever their names.  No shuffle."""
    prepare(docs.sparkSession)
    at = str(docs.columns.index("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays(batch.columns, [str(i) for i in range(batch.num_columns)])
            for piece in pieces([numbered], at, limit):
                kept = piece.filter(pa.array(keep(text_column(piece, at)), pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
