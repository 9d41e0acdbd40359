"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames with some records each, and a seek table as a last, skippable
frame: compressed and plain size of every frame, and a footer that says how many there are.  A record is found by its
frame and its offset in the plain frame; reading it takes the footer, the seek table and one frame.

Equal payloads are stored once: the row with the smallest page id (then url; of equal rows one of them) is a
``response`` record, all others are ``revisit`` records that refer to it.  Payloads shorter than ``min_revisit_bytes``
are always responses.  A record's identifier is its page id and a number that no other record has.

Pages are read and hashed once, into a table in the shared folder.  Tasks write bundles to the shared folder under
names of their own; the list of files that count is a table written by Spark, so a repeated or lost task leaves no
double record.  ``pyarrow`` opens the folder by its URI.

A null or empty html is an empty payload.  Rows that repeat a ``page_id`` are written each.  A row without ``page_id``
comes after all others: it is a revisit of an equal payload that has an id, and of one of its kind where none has
(``refers_to`` is null then).  An empty table gives no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointgate.llm.text import materialise, partitions_for, pieces, prepare
from pointgate.session import scratch_path

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9

INDEX = "page_id long, record long, file string, frame int, start long, size long"


@dataclass(frozen=True)
class WarcOptions:
    frame_bytes: int = 1 << 20
    bundle_bytes: int = 64 << 20
    level: int = 3
    min_revisit_bytes: int = 0


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def bare_digest(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode("ascii")


def identifier(page_id: int | None, number: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{number}>"


def page_of(name: str) -> tuple[int | None, int]:
    """Page id and number in an identifier."""
    page, number = name.removeprefix("<urn:page:").removesuffix(">").split(":")
    return (int(page) if page else None), int(number)


def record(own: str, url: str, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode("ascii") + (payload if refers_to is None else b"")
    target = "".join(c for c in url if c >= " " and c != "\x7f")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {own}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {refers_to}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block, and the end of the record that begins at ``start``."""
    end = data.index(b"\r\n\r\n", start)
    lines = data[start:end].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at offset {start}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    block = data[end + 4 : end + 4 + size]
    if len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
        raise ValueError(f"the record at offset {start} is cut off")
    return fields, block, end + 8 + size


class BundleWriter:
    """Collects records into frames and writes a finished frame at once; memory holds one frame."""

    def __init__(self, stream, options: WarcOptions):
        self.stream, self.options = stream, options
        self.packer = zstandard.ZstdCompressor(level=options.level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.waiting: list[bytes] = []
        self.plain = 0
        self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """The record's frame and its offset there."""
        if self.plain and self.plain + len(data) > self.options.frame_bytes:
            self.flush()
        place = (len(self.frames), self.plain)
        self.waiting.append(data)
        self.plain += len(data)
        return place

    def flush(self) -> None:
        if self.waiting:
            packed = self.packer.compress(b"".join(self.waiting))
            self.stream.write(packed)
            self.frames.append((len(packed), self.plain))
            self.written += len(packed)
            self.waiting, self.plain = [], 0

    def finish(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + FOOTER_BYTES))
        self.stream.write(table + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC))


def seek_table(source, size: int) -> list[tuple[int, int, int]]:
    """Start, compressed size and plain size of each frame, from the end of the file alone."""
    source.seek(size - FOOTER_BYTES)
    count, descriptor, magic = struct.unpack("<IBI", source.read(FOOTER_BYTES))
    if magic != SEEKABLE_MAGIC or descriptor & 0x7C:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if descriptor & 0x80 else 8
    source.seek(size - FOOTER_BYTES - width * count)
    table = source.read(width * count)
    found, start = [], 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", table, k * width)
        found.append((start, packed, plain))
        start += packed
    return found


def read_frame(source, place: tuple[int, int, int]) -> bytes:
    start, packed, plain = place
    source.seek(start)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=plain)


def plan_records(pages: DataFrame, options: WarcOptions) -> DataFrame:
    """page_id, record (its number), url, payload, digest, and page and record that a revisit refers to.

    Only ids and digests are grouped, partial sums first.  The first rows are written, so that the join by digest is
    between plain exchanges and a digest with a third of all pages can be split.
    """
    rows = materialise(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            F.monotonically_increasing_id().alias("record"),
            F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
            F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
        ).withColumn("digest", F.sha1("payload")),
        "warc-pages",
        compression="zstd",
    )
    shared = rows.where(F.length("payload") >= options.min_revisit_bytes).select("page_id", "record", "url", "digest")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "record")
    first = materialise(
        shared.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "warc-firsts",
    )
    revisits = (
        shared.join(first, "digest").where(F.col("record") != F.col("first.record"))
        .select("record", F.col("first.page_id").alias("to_page"), F.col("first.record").alias("to_record"))
    )
    return rows.join(revisits, "record", "left")


def write_archives(pages: DataFrame, folder: str, options: WarcOptions = WarcOptions()) -> DataFrame:
    """Write the bundles below ``folder``; returns the index: a row per record with file, frame, offset and size."""
    spark = pages.sparkSession
    prepare(spark)
    date = "1970-01-01T00:00:00Z"
    filesystem, root = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(folder)
        writer = stream = None
        name, rows = "", []

        def close() -> pa.RecordBatch:
            writer.finish()
            stream.close()
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array([name] * len(rows), pa.string()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())],
                ["page_id", "record", "file", "frame", "start", "size"],
            )

        for piece in pieces(batches, "payload"):
            ids, numbers, urls = (piece.column(c).to_pylist() for c in ("page_id", "record", "url"))
            pages, records = piece.column("to_page").to_pylist(), piece.column("to_record").to_pylist()
            digests = piece.column("digest").to_pylist()
            for k, payload in enumerate(piece.column("payload")):
                data = payload.as_py()
                if writer is None:
                    name, rows = f"bundle-{uuid.uuid4().hex}.warc.zst", []
                    stream = target.open_output_stream(f"{base}/{name}", compression=None)
                    writer = BundleWriter(stream, options)
                own = identifier(ids[k], numbers[k])
                refers_to = None if records[k] is None else identifier(pages[k], records[k])
                made = record(own, urls[k], data, bare_digest(digests[k]), refers_to, date)
                rows.append((ids[k], numbers[k], *writer.add(made), len(made)))
                if writer.written >= options.bundle_bytes:
                    yield close()
                    writer = None
        if writer is not None:
            yield close()

    planned = plan_records(pages, options)
    # One more shuffle is saved by writing in the join's partitions; order within a bundle does not matter.
    return materialise(planned.mapInArrow(run, INDEX), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Read every record of the index from its bundle: header fields and payload digests, checked against the payload.

    Files are dealt out to tasks; a task opens a file once and unpacks one frame at a time.
    """
    spark = index.sparkSession
    prepare(spark)
    files = index.groupBy("file", "frame").agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("at"))
    files = files.repartition(partitions_for(spark), "file").sortWithinPartitions("file", "frame")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(folder)
        name, source, table = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    if source is not None:
                        source.close()
                    name = row["file"]
                    path = f"{base}/{name}"
                    source = target.open_input_file(path)
                    table = seek_table(source, source.size())
                data = read_frame(source, table[row["frame"]])
                out = []
                for at in row["at"]:
                    fields, block, _ = parse(data, at["start"])
                    out.append(outcome(fields, block, at["record"]))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )
        if source is not None:
            source.close()

    return files.mapInArrow(run, schema)


def outcome(fields: dict[str, str], block: bytes, number: int) -> tuple[int | None, int, str, str, int | None]:
    """What a record says; the index and the payload must agree with it."""
    own, found = page_of(fields["WARC-Record-ID"])
    if found != number:
        raise ValueError(f"record {found} where {number} should be")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    end = block.index(b"\r\n\r\n") + 4
    size = int(block[:end].split(b"Content-Length: ")[1].split(b"\r\n")[0])
    if fields["WARC-Type"] == "revisit":
        return own, size, digest, "revisit", page_of(fields["WARC-Refers-To"])[0]
    payload = block[end:]
    if len(payload) != size or digest_of(payload) != digest:
        raise ValueError(f"record {number} does not match its digest")
    return own, size, digest, "response", None


def archive(pages: DataFrame, options: WarcOptions = WarcOptions()) -> DataFrame:
    """Write all pages below the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return read_archives(write_archives(pages, uri, options), uri)
