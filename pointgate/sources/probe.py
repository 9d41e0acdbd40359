"""What files say about themselves before they are read as tables.

One distributed job opens each file in a task: of CSV and TSV it reads ranges from the front until the first record is
whole, of Parquet the footer, of compressed text all bytes (only reading shows whether they end well), of anything
else the first range.  Whatever goes wrong with a file is a value in its row, so no file can end the job.

Tasks open files through ``pyarrow.fs``.  Files of a store that only Spark's readers know (``reached`` is false) are
left to those readers.
"""

from __future__ import annotations

import bz2
import codecs
import csv
import gzip
import io
import sys
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from pointgate.session import ship_package

#: Bytes of the first range; each further one is twice as long.
RANGE = 64 << 10
GONE = "file is gone"
SCHEMA = (
    "path string, kind string, header array<string>, spans_lines boolean, rows bigint, columns string, "
    "bytes_read bigint, error string, reached boolean"
)
_PACKED = {"gz": lambda raw: gzip.GzipFile(fileobj=raw), "bz2": bz2.BZ2File}
_PACKED_ARROW = {"zst": "zstd", "lz4": "lz4"}


@dataclass(frozen=True)
class Dialect:
    """How the first record of a CSV file is told: the reader options that matter for it."""

    sep: str = ","
    quote: str = '"'
    escape: str = '"'
    comment: str = ""
    encoding: str = "UTF-8"

    @classmethod
    def of(cls, sep: str, options: dict[str, object]) -> "Dialect":
        given = {str(k).lower(): v for k, v in options.items()}
        encoding = given.get("encoding", given.get("charset", "UTF-8"))
        quote, escape = given.get("quote", '"'), given.get("escape", '"')
        return cls(str(given.get("sep", given.get("delimiter", sep))), str(quote), str(escape),
                   str(given.get("comment", "")), str(encoding))

    @property
    def wide(self) -> bool:
        """Whether line breaks are more than one byte, so that lines cannot be cut before decoding."""
        return codecs.lookup(self.encoding).name.startswith(("utf-16", "utf-32"))


class _Counted(io.RawIOBase):
    """A stream that counts what is read from it."""

    def __init__(self, source):
        self.source, self.count = source, 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.source.read(len(buffer))
        buffer[: len(data)] = data
        self.count += len(data)
        return len(data)


def opened(path: str):
    """File system and path within it, of a path as Spark spells it; None for stores unknown here."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    try:
        return fs.FileSystem.from_uri(f"s3://{path[6:]}" if parts.scheme == "s3a" else path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return None


def _unpacked(raw: _Counted, path: str):
    """The plain bytes of a file, and whether it is packed (by its extension, as Hadoop tells)."""
    extension = path.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    if extension in _PACKED:
        return _PACKED[extension](raw), True
    if extension in _PACKED_ARROW:
        return pa.CompressedInputStream(pa.PythonFile(raw, "r"), _PACKED_ARROW[extension]), True
    return raw, False


def first_record(stream, dialect: Dialect) -> tuple[list[str], bool]:
    """Cells of the first record that is neither blank nor a comment, and whether it spans lines; reads no further.

    No record: no cells.  A byte order mark is no part of it.
    """
    csv.field_size_limit(sys.maxsize)
    plain = codecs.lookup(dialect.encoding).name
    decode = codecs.getincrementaldecoder("utf-8-sig" if plain == "utf-8" else plain)(
        "replace" if plain == "utf-8" else "strict"  # as Spark reads malformed UTF-8
    )
    options = {"delimiter": dialect.sep, "skipinitialspace": False, "strict": False}
    options |= {"quotechar": dialect.quote} if dialect.quote else {"quoting": csv.QUOTE_NONE}
    if dialect.escape and dialect.escape != dialect.quote:
        options |= {"escapechar": dialect.escape, "doublequote": False}
    text, at, size, ended = "", 0, RANGE, False
    while True:
        lines = io.StringIO(text[at:], newline="")
        while line := lines.readline():
            whole = line[-1] in "\r\n" or ended
            if not whole:
                break
            if line.strip() and not (dialect.comment and line.startswith(dialect.comment)):
                lines = io.StringIO(text[at:], newline="")
                reader = csv.reader(iter(lines.readline, ""), **options)
                cells = next(reader, [])
                if not ended and lines.tell() >= len(text) - at:
                    break  # the record may go on, in quotes
                return cells, reader.line_num > 1
            at += len(line)
        if ended:
            return [], False
        data = stream.read(size)
        ended = not data
        text += decode.decode(data, ended)
        size *= 2


def _parquet(source) -> tuple[int, str]:
    file = pq.ParquetFile(source)
    columns = "\n".join(f"{f.name}: {f.type}" for f in file.schema_arrow)
    return file.metadata.num_rows, columns


def probed(path: str, kind: str, dialects: dict[str, Dialect]) -> tuple:
    header, spans, rows, columns, raw, error = None, False, None, None, None, None
    place = opened(path)
    if place is None:
        return path, kind, None, False, None, None, 0, None, False
    try:
        system, inner = place
        if kind == "parquet":
            with system.open_input_file(inner) as source:
                rows, columns = _parquet(source)
        else:
            with system.open_input_stream(inner, compression=None) as source:
                raw = _Counted(source)
                stream, packed = _unpacked(raw, inner)
                if kind in dialects:
                    header, spans = first_record(stream, dialects[kind])
                else:
                    stream.read(1)
                while packed and stream.read(1 << 20):
                    pass
    except FileNotFoundError:
        error = GONE
    except UnicodeError as e:
        error = f"text is not {getattr(e, 'encoding', 'decodable')}"
    except (OSError, EOFError, zlib.error, pa.ArrowException, csv.Error) as e:
        error = str(e).split("\n")[0][:200] or type(e).__name__
    return path, kind, header, spans, rows, columns, raw.count if raw else 0, error, True


def probe(spark: SparkSession, files: Sequence[tuple[str, str]], dialects: dict[str, Dialect]) -> DataFrame:
    """One row per (path, kind): see ``SCHEMA``.  ``dialects`` says of which kinds a header is wanted, and how."""
    ship_package()
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_(), pa.int64(), pa.string(), pa.int64(),
             pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [probed(p, k, dialects) for p, k in zip(*(c.to_pylist() for c in batch.columns))]
            columns = zip(*found) if found else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)

    tasks = max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame(list(files), "path string, kind string")
    return listed.repartition(tasks, "path").mapInArrow(run, SCHEMA)
