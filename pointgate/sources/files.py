"""CSV, TSV, JSON, JSON lines and Parquet files, and folders that mix them."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointgate.functions.json import is_valid_json
from pointgate.functions.payloads import oversize_preview
from pointgate.operators import normalize as N
from pointgate.operators import points as P
from pointgate.options import PointMapping
from pointgate.sources.probe import GONE, Dialect, probe

FILE_ORDER = ("file_path", "file_block", "file_row")

_CORRUPT = "__corrupt"
_PACKED = r"\.(?:gz|bz2|zst|lz4|deflate|snappy)"
#: Reader options that choose files; all others say how their content is read.
_LISTING = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter")
#: Files that end early, or are gone, give what could be read; the probe has told which.
_LENIENT = {"ignoreCorruptFiles": True, "ignoreMissingFiles": True}
_EXTENSIONS = {"parquet": "parquet", "json": "json", "jsonl": "jsonl", "ndjson": "jsonl", "tsv": "tsv", "csv": "csv"}


def resolve_format(path: str, declared: str = "auto") -> str:
    """The declared format, unless empty or ``auto``: then by extension (before that of a packed file), csv when unknown."""
    if declared and declared != "auto":
        return declared
    found = re.search(rf"\.([^./]+?)(?:{_PACKED})?\Z", path)
    return _EXTENSIONS.get(found.group(1) if found else "", "csv")


def _reader(spark: SparkSession, options: dict[str, object]):
    reader = spark.read
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader


def _content(options: dict[str, object]) -> dict[str, object]:
    return {k: v for k, v in options.items() if k not in _LISTING}


def _after(df: DataFrame, cursor: str | None) -> DataFrame:
    """Skip files up to ``cursor``; the filter on the file path prunes whole files before reading."""
    return df if cursor is None else df.filter(F.col("_metadata.file_path") > cursor)


def _file_columns(row: Column | None = None) -> list[Column]:
    # Ids rise within a partition, and a partition reads a block in order.
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block"),
        (F.monotonically_increasing_id() if row is None else row).alias("file_row"),
    ]


def _only(format_name: str) -> Column:
    """Files of a format by extension; csv also takes every unknown one."""
    name = F.col("_metadata.file_name")
    others = [e for e, f in _EXTENSIONS.items() if f != "csv"]
    if format_name == "csv":
        return ~name.rlike(r"\.(?:" + "|".join(others) + rf")(?:{_PACKED})?\z")
    wanted = [e for e, f in _EXTENSIONS.items() if f == format_name]
    return name.rlike(r"\.(?:" + "|".join(wanted) + rf")(?:{_PACKED})?\z")


@dataclass(frozen=True)
class CsvGroup:
    """Files that begin with the same header."""

    names: tuple[str, ...]
    paths: tuple[str, ...]
    multi_line: bool


def _header_names(cells: Sequence[str]) -> tuple[str, ...]:
    names = [c.strip() for c in cells]
    # a name that comes twice gets its position, as Spark's own reader does
    return tuple(f"{n}{i}" if names.count(n) > 1 or not n else n for i, n in enumerate(names))


def _paths(
    spark: SparkSession, path: str | list[str], cursor: str | None, by_extension: str | None, options: dict
) -> list[str]:
    """The files of a read in order, spelled as in ``_metadata.file_path``; their contents are not read."""
    chosen = {k: v for k, v in options.items() if k in _LISTING}
    files = _after(_reader(spark, chosen).format("binaryFile").load(path), cursor)
    if by_extension is not None:
        files = files.filter(_only(by_extension))
    return [row["path"] for row in files.select(F.col("_metadata.file_path").alias("path")).orderBy("path").collect()]


def _first_lines(spark: SparkSession, paths: Sequence[str], dialect: Dialect) -> dict[str, list[str]]:
    """Cells of the first line that is neither blank nor a comment, by Spark's reader: for stores only it can open."""
    lines = spark.read.text([unquote(p) for p in paths]).filter(F.trim("value") != "")
    if dialect.comment:
        lines = lines.filter(~F.col("value").startswith(dialect.comment))
    firsts = (
        lines.filter("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
        .groupBy("path")
        .agg(F.min_by("value", "at").alias("line"))
    )
    cells = lambda line: next(csv.reader([line.removeprefix("\ufeff")], delimiter=dialect.sep), [])
    return {row["path"]: cells(row["line"].rstrip("\r")) for row in firsts.collect()}


def csv_catalogue(
    spark: SparkSession, paths: Sequence[str], dialect: Dialect, kind: str = "csv", probed: Sequence | None = None
) -> tuple[list[CsvGroup], list[tuple[str, str]]]:
    """The distinct headers of CSV files, each with its files, and (path, error) of those that cannot be read whole.

    Only the front of each file is read (``probe``); ``probed`` gives rows of an earlier probe.  Files without a record belong to no group; a file
    with an error belongs to one if its header could be read.
    """
    if not paths:
        return [], []
    found = probe(spark, [(p, kind) for p in paths], {kind: dialect}).collect() if probed is None else probed
    beyond = [row["path"] for row in found if not row["reached"]]
    lines = _first_lines(spark, beyond, dialect) if beyond else {}
    groups: dict[tuple, list[str]] = {}
    for row in sorted(found, key=lambda r: r["path"]):
        header = _header_names(row["header"] or lines.get(row["path"], []))
        if header:
            groups.setdefault((header, row["spans_lines"] or dialect.wide), []).append(unquote(row["path"]))
    errors = [(row["path"], row["error"]) for row in found if row["error"] is not None]
    return [CsvGroup(header, tuple(files), spans) for (header, spans), files in groups.items()], errors


def csv_columns(spark: SparkSession, path: str | list[str], sep: str = ",", has_headers: bool = True, **options) -> list[str]:
    """Column names from the first line only; positional names when there is no header."""
    # One line is read; types are never inferred.
    reader = _reader(spark, {"sep": sep, "header": has_headers, "quote": '"', "escape": '"', **options})
    return [c.strip() for c in reader.csv(path).columns]


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    sep: str = ",",
    trim: bool = True,
    has_headers: bool = True,
    multi_line: bool = False,
    cursor: str | None = None,
    by_extension: str | None = None,
    **options,
) -> DataFrame:
    """CSV -> string cells plus ``error_code``/``parse_error`` of unreadable (ragged) records.

    Records whose cells are all blank are skipped.  ``multi_line`` allows line breaks in quoted cells, at the
    price of one task per file.  Without ``columns`` every file is read by its own header; columns that a file lacks
    are null (``csv_file_points`` keeps each file's cells apart).
    """
    if columns is None and has_headers:
        paths = _paths(spark, path, cursor, by_extension, options)
        groups, errors = csv_catalogue(spark, paths, Dialect.of(sep, options))
        if errors:
            raise OSError(f"cannot read {errors[0][0]}: {errors[0][1]}")
        kept = _content(options)
        parts = [
            read_csv(spark, list(g.paths), g.names, sep, trim, has_headers, multi_line or g.multi_line, **kept)
            for g in groups
        ]
        if parts:
            union = parts[0]
            for part in parts[1:]:
                union = union.unionByName(part, allowMissingColumns=True)
            return union
    names = list(columns or csv_columns(spark, path, sep, has_headers, **options))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    reader = _reader(
        spark,
        {
            "header": has_headers,
            "sep": sep,
            "quote": '"',
            "escape": '"',
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": _CORRUPT,
            "ignoreLeadingWhiteSpace": trim,
            "ignoreTrailingWhiteSpace": trim,
            "multiLine": multi_line,
            # With pruning, selecting fewer columns silently un-flags ragged records.
            "columnPruning": False,
            **options,
        },
    )
    df = _after(reader.schema(schema).csv(path), cursor)
    if by_extension is not None:
        df = df.filter(_only(by_extension))
    df = df.select(*[F.col(f"`{n}`") for n in [*names, _CORRUPT]], *_file_columns())
    blank = F.lit(True)
    for name in names:
        blank = blank & (F.trim(F.coalesce(F.col(f"`{name}`"), F.lit(""))) == "")
    # Always true, but it names a data column: Spark refuses to read the corrupt-record column alone.
    some_cell = F.length(F.concat_ws("", F.col(f"`{names[0]}`"))) >= 0
    unreadable = F.col(_CORRUPT).isNotNull() & some_cell
    return (
        df.filter(unreadable | ~blank)
        .withColumns(
            {
                "error_code": F.when(unreadable, F.lit(P.CSV_READ_ERROR)),
                "parse_error": F.when(unreadable, F.lit("record does not have the header's number of fields")),
                "unreadable": F.col(_CORRUPT),
            }
        )
        .drop(_CORRUPT)
    )


def csv_points(
    df: DataFrame,
    mapping: PointMapping,
    strict: bool = True,
    as_of_ms: int | None = None,
    keep_unreadable: bool = False,
) -> DataFrame:
    """Cells of ``read_csv`` -> points.  The raw text of an unreadable record is empty unless kept."""
    cells = [c for c in df.columns if c not in (*FILE_ORDER, "error_code", "parse_error", "unreadable")]
    broken = F.col("unreadable") if keep_unreadable else F.lit("")
    raw = F.when(F.col("error_code").isNotNull(), broken).otherwise(N.csv_record_text(cells))
    points = N.normalize_csv(df, mapping, cells, strict, as_of_ms, raw)
    return points.select(*FILE_ORDER, *P.POINT_COLUMNS)


def csv_file_points(
    spark: SparkSession,
    path: str | list[str],
    mapping: PointMapping,
    sep: str = ",",
    trim: bool = True,
    strict: bool = True,
    as_of_ms: int | None = None,
    keep_unreadable: bool = False,
    cursor: str | None = None,
    by_extension: str | None = None,
    **options,
) -> DataFrame:
    """CSV files with headers of their own -> points; one reader per distinct header.

    All reader options reach the search for headers and the readers alike.  A file that cannot be read to its end
    gives its readable records and one rejected point.
    """
    paths = _paths(spark, path, cursor, by_extension, options)
    groups, errors = csv_catalogue(spark, paths, Dialect.of(sep, options))
    return _csv_points_of(
        spark, groups, [(p, "csv", e) for p, e in errors], mapping, sep, trim, strict, as_of_ms, keep_unreadable, options
    )


def _csv_points_of(
    spark: SparkSession,
    groups: Sequence[CsvGroup],
    errors: Sequence[tuple[str, str, str]],
    mapping: PointMapping,
    sep: str,
    trim: bool,
    strict: bool,
    as_of_ms: int | None,
    keep_unreadable: bool,
    options: dict,
) -> DataFrame:
    parts = [unreadable_files(spark, errors).drop("format")] if errors else []
    kept = _content(options) | (_LENIENT if errors else {})
    for group in groups:
        multi_line = bool(kept.get("multiLine")) or group.multi_line
        rest = {k: v for k, v in kept.items() if k != "multiLine"}
        cells = read_csv(spark, list(group.paths), group.names, sep, trim, multi_line=multi_line, **rest)
        parts.append(csv_points(cells, mapping, strict, as_of_ms, keep_unreadable))
    if not parts:
        nothing = spark.createDataFrame([], "file_path string, file_block long, file_row long")
        return P.with_point(nothing, F.lit(0).cast("bigint"), F.array(F.lit(0.0)), F.lit("")).select(
            *FILE_ORDER, *P.POINT_COLUMNS
        )
    return reduce(DataFrame.union, parts)


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    max_line_bytes: int | None = None,
    hash_raw: bool = False,
    cursor: str | None = None,
    by_extension: str | None = None,
    **options,
) -> DataFrame:
    """JSON lines -> ``raw`` text (splittable).  Blank lines are skipped; lines over a cap, if set, are flagged."""
    df = _after(_reader(spark, {"lineSep": "\n", **options}).text(path), cursor)
    if by_extension is not None:
        df = df.filter(_only(by_extension))
    df = df.select("value", *_file_columns())
    # The line break counts towards the cap.
    over = F.lit(False) if max_line_bytes is None else F.octet_length("value") + 1 > max_line_bytes
    text = F.make_valid_utf8("value")
    return (
        df.filter(F.col("value").rlike(r"[^ \t\n\f\r]"))
        .withColumns(
            {
                "error_code": F.when(over, F.lit(P.OVERSIZE)),
                "parse_error": F.when(over, F.lit(f"line longer than {max_line_bytes} bytes")),
                "raw": text
                if max_line_bytes is None
                else F.when(over, oversize_preview(F.col("value"), max_line_bytes, hash_raw)).otherwise(text),
            }
        )
        .drop("value")
    )


def read_json(
    spark: SparkSession,
    path: str | list[str],
    max_bytes: int | None = None,
    cursor: str | None = None,
    by_extension: str | None = None,
    **options,
) -> DataFrame:
    """JSON documents -> one ``raw`` text per record.

    The root is an array, or an object whose first present key of rows, data, records holds the array.  Any
    other document gives one rejected record.  A document cannot be split: use JSON lines for big files.
    """
    df = _after(_reader(spark, options).text(path, wholetext=True), cursor)
    if by_extension is not None:
        df = df.filter(_only(by_extension))
    df = df.select("value", *_file_columns(F.lit(0).cast("bigint")))
    first = F.regexp_extract("value", r"\A\s*(\S)", 1)
    wrapper = "rows array<string>, data array<string>, records array<string>"
    df = df.withColumns(
        {
            "__first": first,
            "__big": F.lit(False) if max_bytes is None else (first == "{") & (F.octet_length("value") > max_bytes),
        }
    )
    # Typed lists forgive syntax errors inside them, so the whole document is checked first.
    df = df.withColumn("__valid", F.when(~F.col("__big"), is_valid_json(F.col("value"))).otherwise(F.lit(False)))
    as_object = (F.col("__first") == "{") & F.col("__valid")
    df = df.withColumns(
        {
            "__keys": F.when(as_object, F.json_object_keys("value")),
            "__wrapped": F.when(as_object, F.from_json("value", wrapper)),
            "__root": F.when(
                (F.col("__first") == "[") & F.col("__valid"), F.from_json("value", "array<string>")
            ),
        }
    )
    has = lambda key: F.array_contains("__keys", key)
    rows = (
        F.when(F.col("__root").isNotNull(), F.col("__root"))
        .when(has("rows"), F.col("__wrapped.rows"))
        .when(has("data"), F.col("__wrapped.data"))
        .when(has("records"), F.col("__wrapped.records"))
    )
    # The texts, which consumers of the dead letter match.
    problem = (
        F.when(F.col("__big"), F.lit(f"JSON document exceeds {max_bytes} bytes"))
        .when(~F.col("__first").isin("[", "{"), F.lit("JSON root must be array or object"))
        .when(~F.col("__valid"), F.lit("invalid JSON"))
        .otherwise(F.lit("JSON object must have 'rows', 'data', or 'records' array"))
    )
    listed = df.withColumn("__rows", rows).select(
        "file_path",
        "file_block",
        "__big",
        F.when(F.col("__rows").isNull(), problem).alias("parse_error"),
        F.when(F.col("__rows").isNull() & ~F.col("__big"), F.col("value")).alias("__text"),
        F.coalesce("__rows", F.array(F.lit(None).cast("string"))).alias("__rows"),
    )
    exploded = listed.select(
        "file_path", "file_block", "__big", "parse_error", "__text", F.posexplode("__rows").alias("file_row", "__item")
    )
    return exploded.select(
        "file_path",
        "file_block",
        F.col("file_row").cast("bigint").alias("file_row"),
        F.when(F.col("parse_error").isNotNull(), F.when(F.col("__big"), F.lit(P.OVERSIZE)).otherwise(F.lit(P.PARSE_ERROR)))
        .alias("error_code"),
        "parse_error",
        F.coalesce("__item", "__text", F.lit("null")).alias("raw"),
    )


def json_points(df: DataFrame, mapping: PointMapping, as_of_ms: int | None = None) -> DataFrame:
    """``read_json``/``read_jsonl`` rows -> points."""
    return N.normalize_json_map(df, "raw", mapping, as_of_ms).select(*FILE_ORDER, *P.POINT_COLUMNS)


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    cursor: str | None = None,
    by_extension: str | None = None,
    **options,
) -> DataFrame:
    """Parquet with its own schema; only columns used later are read."""
    df = _after(_reader(spark, options).parquet(*([path] if isinstance(path, str) else path)), cursor)
    if by_extension is not None:
        df = df.filter(_only(by_extension))
    return df.select("*", *_file_columns(F.col("_metadata.row_index")))


def parquet_points(df: DataFrame, mapping: PointMapping, as_of_ms: int | None = None) -> DataFrame:
    """``read_parquet`` rows -> points; the raw form of a row is its number."""
    raw = F.concat(F.lit("row_"), F.col("file_row").cast("string"))
    return N.normalize_columns(df, mapping, raw, as_of_ms).select(*FILE_ORDER, *P.POINT_COLUMNS)


_JSON_READY = (
    T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType, T.StringType,
)


def passthrough_lines(df: DataFrame, render_all: bool = True) -> DataFrame:
    """Every row as a JSON object of all its columns, unchecked (column ``line``).

    Without ``render_all``, columns of other types than numbers, booleans and text give null.
    """
    cells = []
    for f in df.schema.fields:
        if f.name in FILE_ORDER:
            continue
        ready = render_all or isinstance(f.dataType, _JSON_READY)
        value = F.col(f"`{f.name}`") if ready else F.lit(None).cast("string")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # No JSON number exists for these.
            value = F.when(~N.is_finite(value), F.lit(None)).otherwise(value)
        cells.append(value.alias(f.name))
    return df.select(F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}).alias("line"))


def list_files(spark: SparkSession, root: str, cursor: str | None = None) -> list[tuple[str, str]]:
    """(path, format by extension) of the files below a folder after ``cursor``, in order; contents are not read.

    Paths are spelled as in ``_metadata.file_path``.  The driver gets one path per file, as it does when Spark
    lists them.
    """
    files = _reader(spark, {"recursiveFileLookup": True}).format("binaryFile").load(root)
    rows = _after(files, cursor).select(F.col("_metadata.file_path").alias("path")).orderBy("path").collect()
    return [(row["path"], resolve_format(row["path"])) for row in rows]


def _opens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: whether a small file's bytes are a Parquet file."""
    for batch in batches:
        good = []
        for content in batch.column(1):
            try:
                pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                good.append(True)
            except (pa.ArrowException, OSError):
                good.append(False)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(good)], ["path", "good"])


def parquet_rows(spark: SparkSession, paths: Sequence[str]) -> dict[str, int | None]:
    """Rows that the footer of each Parquet file promises; null when it cannot be read.  Columns are not read."""
    if not paths:
        return {}
    plain = [unquote(p) for p in paths]
    # A column no file has: only footers are opened, and no schema has to be inferred.
    probe = _reader(spark, {"ignoreCorruptFiles": True}).schema("pointgate_nothing int").parquet(*plain)
    counted = probe.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows")).collect()
    found: dict[str, int | None] = dict.fromkeys(paths)
    found.update({row["path"]: row["rows"] for row in counted})
    silent = [unquote(p) for p in paths if found[p] is None]
    if silent:
        # Damaged, or without rows; a file without rows is little more than a footer.
        files = spark.read.format("binaryFile").load(silent).filter(F.col("length") < 64 << 20)
        files = files.select(F.col("_metadata.file_path").alias("path"), "content")
        empty = files.mapInArrow(_opens, "path string, good boolean").filter("good").collect()
        found.update({row["path"]: 0 for row in empty})
    return found


def unreadable_files(spark: SparkSession, files: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One rejected point per file (path, format, reason) that could not be read whole; the raw text is its path."""
    rows = spark.createDataFrame(list(files), "file_path string, format string, reason string")
    rows = rows.withColumns({"file_block": F.lit(0).cast("bigint"), "file_row": F.lit(-1).cast("bigint")})
    points = P.with_point(
        rows,
        F.lit(None).cast("bigint"),
        F.lit(None).cast("array<double>"),
        F.col("file_path"),
        parse_error=F.concat(F.lit("unreadable "), F.col("format"), F.lit(" file: "), F.col("reason")),
        error_code=F.lit(P.FILE_READ_ERROR),
    )
    return points.select(*FILE_ORDER, *P.POINT_COLUMNS, "format")


#: How the header of each text format with one is found.
DIALECTS = {"csv": Dialect(), "tsv": Dialect(sep="\t")}


def catalogue(spark: SparkSession, files: Sequence[tuple[str, str]]) -> list:
    """The probe's row of each (path, format), with rows of Parquet files counted by Spark where only it reaches them."""
    if not files:
        return []
    found = probe(spark, files, DIALECTS).collect()
    beyond = [row["path"] for row in found if not row["reached"] and row["kind"] == "parquet"]
    counted = parquet_rows(spark, beyond)
    none = "no readable footer"
    return [
        Row(**row.asDict() | {"rows": counted[row["path"]], "error": none if counted[row["path"]] is None else None})
        if row["path"] in counted else row for row in found
    ]


def _parquet_parts(
    spark: SparkSession, found: Sequence, mapping: PointMapping, as_of_ms: int | None, lenient: bool
) -> list[DataFrame]:
    """One reader per distinct set of column types; files whose columns cannot be points are rejected whole."""
    groups: dict[str, list[str]] = {}
    bad = [(row["path"], "parquet", row["error"]) for row in found if row["error"] is not None]
    for row in found:
        if row["error"] is None:
            groups.setdefault(row["columns"] or "", []).append(row["path"])
    parts = []
    for paths in groups.values():
        rows = read_parquet(spark, [unquote(p) for p in paths], **(_LENIENT if lenient else {}))
        try:
            parts.append(parquet_points(rows, mapping, as_of_ms))
        except (ValueError, TypeError) as problem:
            bad += [(path, "parquet", str(problem)) for path in paths]
    if bad:
        parts.append(unreadable_files(spark, bad).drop("format"))
    return parts


def directory_points(
    spark: SparkSession,
    root: str,
    mapping: PointMapping,
    formats: Sequence[str] = ("csv", "tsv", "json", "jsonl", "parquet"),
    csv_names: Sequence[str] | None = None,
    as_of_ms: int | None = None,
    cursor: str | None = None,
    found: Sequence | None = None,
    lenient: bool = False,
) -> DataFrame:
    """A folder tree of mixed files -> points with ``file_path`` and ``format``.

    One reader per format present (for CSV and TSV: per distinct header, for Parquet: per distinct column types), so
    files are read in parallel.  Files of other extensions are read as CSV.  ``cursor`` skips files up to that path;
    ``found`` gives the listing instead (``catalogue``).  A text file that cannot be opened or does not end well
    (packed, cut short) gives what could be read and one rejected point, a Parquet file without a readable footer,
    or whose columns cannot be points, the rejected point alone.  A Parquet file damaged further in, or a file that
    goes away meanwhile, ends the query, unless ``lenient``: then the caller holds the rows of the footers against
    those that came.
    """
    for name in formats:
        if name not in _EXTENSIONS.values():
            raise ValueError(f"unsupported file format: {name}")
    listed = catalogue(spark, list_files(spark, root, cursor)) if found is None else found
    parts = []
    for name in formats:
        rows = [row for row in listed if row["kind"] == name]
        if not rows:
            continue
        errors = [(row["path"], name, row["error"]) for row in rows if row["error"] is not None]
        careful = _LENIENT if lenient or errors else {}
        gone = {path for path, _, error in errors if error == GONE}
        plain = [unquote(row["path"]) for row in rows if row["path"] not in gone]
        if name in DIALECTS:
            sep = DIALECTS[name].sep
            if csv_names:
                cells = read_csv(spark, plain, csv_names, sep, trim=False, **careful)
                made = [csv_points(cells, mapping, strict=False, as_of_ms=as_of_ms, keep_unreadable=True)] if plain else []
            else:
                groups, _ = csv_catalogue(spark, [row["path"] for row in rows], DIALECTS[name], name, rows)
                made = [_csv_points_of(spark, groups, [], mapping, sep, False, False, as_of_ms, True, careful)]
        elif name == "json":
            made = [json_points(read_json(spark, plain, **careful), mapping, as_of_ms)] if plain else []
        elif name == "jsonl":
            made = [json_points(read_jsonl(spark, plain, **careful), mapping, as_of_ms)] if plain else []
        else:
            made, errors = _parquet_parts(spark, rows, mapping, as_of_ms, lenient), []
        if errors:
            made.append(unreadable_files(spark, errors).drop("format"))
        parts += [points.withColumn("format", F.lit(name)) for points in made]
    if not parts:
        raise ValueError(f"no files of the formats {', '.join(formats)} below {root}")
    return reduce(DataFrame.unionByName, parts)
