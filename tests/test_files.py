import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from pointgate.operators import points as P
from pointgate.options import Bound, GateOptions, OutputOptions, PointMapping, TimeSpec
from pointgate.plans import folder
from pointgate.plans.folder import run_folder
from pointgate.sources import cursor
from pointgate.sources import files as S

NOW = 1_700_000_000_000
MAPPING = PointMapping({"price": 0, "volume": 1}, 2, TimeSpec(field="t"))


def points(df, **how):
    rows = S.csv_points(df, MAPPING, as_of_ms=NOW, **how).orderBy(*S.FILE_ORDER).collect()
    return [(r.error_code, r.metrics, r.raw) for r in rows]


def test_csv(spark, tmp_path):
    body = 't , price,volume\n1, 1.5 ,"2"\n\n , ,\n1,2\n1,2,3,4\n1,x,"a ""b"", c"\n'
    (tmp_path / "a.csv").write_text(body)
    df = S.read_csv(spark, str(tmp_path))
    assert [c for c in df.columns if c in ("t", "price", "volume")] == ["t", "price", "volume"]
    want = [
        (None, [1.5, 2.0], "1|1.5|2"),
        (P.CSV_READ_ERROR, None, ""),
        (P.CSV_READ_ERROR, None, ""),
        (P.PARSE_ERROR, None, '1|x|a "b", c'),
    ]
    assert points(df) == want
    assert [p[2] for p in points(df, keep_unreadable=True)][1:3] == ["1,2", "1,2,3,4"]


def test_ragged_rows_survive_narrow_selects(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t,price,volume\n1,2,3\n1,2\n1,2,3,4\n")
    assert S.read_csv(spark, str(tmp_path)).filter("error_code is not null").select("file_path").count() == 2


def test_csv_without_trimming(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t,price,volume\n1, 2,3\n")
    assert points(S.read_csv(spark, str(tmp_path), trim=False))[0][0] == P.PARSE_ERROR


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2,3\n4,5,6\n")
    df = S.read_csv(spark, str(tmp_path), has_headers=False)
    mapping = PointMapping({"_c1": 0}, 1, TimeSpec(field="_c0"))
    rows = S.csv_points(df, mapping, as_of_ms=NOW).collect()
    assert sorted(r.metrics[0] for r in rows) == [2.0, 5.0]


def test_csv_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('t,price,volume,note\n1,2,3,"x\ny"\n')
    rows = points(S.read_csv(spark, str(tmp_path), multi_line=True))
    assert rows == [(None, [2.0, 3.0], "1|2|3|x\ny")]


def json_rows(spark, path):
    mapping = PointMapping({"v": 0}, 1)
    rows = S.json_points(S.read_json(spark, str(path)), mapping, NOW).orderBy(*S.FILE_ORDER).collect()
    return [(r.error_code, r.parse_error, r.metrics[0] if r.metrics else None, r.file_row) for r in rows]


@pytest.mark.parametrize(
    "text,want",
    [
        ('[{"v":1},{"v":2}]', [(None, None, 1.0, 0), (None, None, 2.0, 1)]),
        ('\n {"rows":[{"v":1}]}', [(None, None, 1.0, 0)]),
        ('{"data":[{"v":"1"}],"x":{"rows":[]}}', [(None, None, 1.0, 0)]),
        ('{"records":[{"v":1}]}', [(None, None, 1.0, 0)]),
        ('{"records":[{"v":1}],"data":[{"v":2}]}', [(None, None, 2.0, 0)]),
        # The first present key counts, even when it is no list.
        ('{"rows":null,"data":[{"v":2}]}', [(P.PARSE_ERROR, "JSON object must have 'rows', 'data', or 'records' array", None, 0)]),
        ('{"v":1}', [(P.PARSE_ERROR, "JSON object must have 'rows', 'data', or 'records' array", None, 0)]),
        ("5", [(P.PARSE_ERROR, "JSON root must be array or object", None, 0)]),
        ('{"rows":[', [(P.PARSE_ERROR, "invalid JSON", None, 0)]),
        ('{"rows":[{"v":1},{"v":2]}', [(P.PARSE_ERROR, "invalid JSON", None, 0)]),
        ('[{"v":1},{"v":2}', [(P.PARSE_ERROR, "invalid JSON", None, 0)]),
        ("[1,{}]", [(P.PARSE_ERROR, "Missing Field: v", None, 0), (P.PARSE_ERROR, "Missing Field: v", None, 1)]),
        ("[]", []),
    ],
)
def test_json_documents(spark, tmp_path, text, want):
    (tmp_path / "a.json").write_text(text)
    assert json_rows(spark, tmp_path) == want


def test_big_wrapped_json_is_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"rows":[{"v":1}]}')
    (tmp_path / "b.json").write_text('[{"v":1},{"v":1}]')
    rows = S.read_json(spark, str(tmp_path), max_bytes=10).collect()
    assert sorted((r.error_code or "", r.raw) for r in rows) == [("", '{"v":1}'), ("", '{"v":1}'), (P.OVERSIZE, "null")]


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"v":1}\r\n\n \t\n{"v":"\xff"}\nnope\n{"v":' + b"1" * 50 + b"}\n")
    rows = S.json_points(S.read_jsonl(spark, str(tmp_path), 40), PointMapping({"v": 0}, 1), NOW).orderBy(*S.FILE_ORDER)
    got = [(r.error_code, r.raw) for r in rows.collect()]
    assert got == [
        (None, '{"v":1}\r'),
        (P.PARSE_ERROR, '{"v":"�"}'),
        (P.PARSE_ERROR, "nope"),
        (P.OVERSIZE, '{"v":' + "1" * 50 + "} (truncated)"),
    ]
    hashed = S.read_jsonl(spark, str(tmp_path), 40, hash_raw=True).filter(F.col("error_code") == P.OVERSIZE).first()
    assert len(hashed.raw) == 64


def test_line_cap_counts_the_line_break(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("12345\n123456\n")
    rows = S.read_jsonl(spark, str(tmp_path), 6).orderBy("file_row").collect()
    assert [r.error_code for r in rows] == [None, P.OVERSIZE]


def test_parquet_reads_mapped_columns_only(spark, tmp_path):
    spark.range(3).selectExpr("id", "cast(id as double) price", "cast(id as int) volume", "id t", "'x' pad").write.parquet(
        str(tmp_path / "p")
    )
    df = S.parquet_points(S.read_parquet(spark, str(tmp_path / "p")), MAPPING, NOW)
    assert sorted(r.metrics[0] for r in df.collect()) == [0.0, 1.0, 2.0]
    scan = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
    assert "pad" not in scan[0] and "id:" not in scan[0]


def test_passthrough(spark):
    df = spark.sql("select 1 a, cast('nan' as double) b, 'x' c, timestamp'2024-01-01' d, true e, cast(null as string) f, 1.5BD g")
    line = json.loads(S.passthrough_lines(df, render_all=False).first().line)
    assert line == {"a": 1, "b": None, "c": "x", "d": None, "e": True, "f": None, "g": None}
    assert json.loads(S.passthrough_lines(df).first().line)["g"] == 1.5


def make_tree(root):
    (root / "a" / "b").mkdir(parents=True)
    (root / "a" / "1.csv").write_text("t,price,volume\n1,1,1\n")
    (root / "a" / "2.dat").write_text("t,price,volume\n1,2,1\n")
    (root / "a" / "b" / "3.tsv").write_text("t\tprice\tvolume\n1\t3\t1\n")
    (root / "a" / "b" / "4.jsonl").write_text('{"t":1,"price":4,"volume":1}\n')
    (root / "a" / "b" / "5.ndjson").write_text('{"t":1,"price":5,"volume":1}\n')
    (root / "6.json").write_text('[{"t":1,"price":6,"volume":1},{"t":1,"price":7,"volume":1}]')
    (root / "7").write_text("t,price,volume\n1,8,1\n")


def test_mixed_tree(spark, tmp_path):
    make_tree(tmp_path)
    df = S.directory_points(spark, str(tmp_path), MAPPING, ("csv", "tsv", "json", "jsonl"), as_of_ms=NOW)
    got = sorted((r.metrics[0], r.format) for r in df.collect())
    assert got == [
        (1.0, "csv"), (2.0, "csv"), (3.0, "tsv"), (4.0, "jsonl"), (5.0, "jsonl"), (6.0, "json"), (7.0, "json"), (8.0, "csv"),
    ]


def test_cursor_skips_whole_files(spark, tmp_path):
    make_tree(tmp_path)
    df = S.directory_points(spark, str(tmp_path), MAPPING, ("csv", "tsv", "json", "jsonl"), as_of_ms=NOW)
    first = df.agg(F.max("file_path")).first()[0]
    prefix = first[: first.index(str(tmp_path))]
    later = S.directory_points(
        spark, str(tmp_path), MAPPING, ("csv", "tsv", "json", "jsonl"), as_of_ms=NOW,
        cursor=prefix + str(tmp_path / "a" / "1.csv"),
    )
    assert sorted(r.metrics[0] for r in later.collect()) == [2.0, 3.0, 4.0, 5.0]


def test_cursor_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert cursor.load_cursor(spark, path) is None
    cursor.save_cursor(spark, path, "file:/a/1.csv")
    assert cursor.load_cursor(spark, path) == "file:/a/1.csv"
    cursor.save_cursor(spark, path, "file:/a/2.csv", cursor.COMPLETED)
    with pytest.raises(cursor.RunCompleted):
        cursor.load_cursor(spark, path)


def test_formats():
    assert S.resolve_format("x/y.ndjson") == "jsonl"
    assert S.resolve_format("x/y.dat") == "csv"
    assert S.resolve_format("x.d/y") == "csv"
    assert S.resolve_format("x/y.json", "tsv") == "tsv"
    assert S.resolve_format("x/y.parquet", "") == "parquet"
    assert S.resolve_format("x/y.CSV") == "csv"
    assert [S.resolve_format(n) for n in ("a.jsonl.gz", "b.gz", "a.json.x.gz", "d.tsv.bz2")] == ["jsonl", "csv", "csv", "tsv"]


def test_every_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t,price,volume\n1,10,1\n")
    (tmp_path / "b b.csv").write_text("\ufefft,volume,price\r\n1,2,20\r\n")
    (tmp_path / "c.csv").write_text("t,more,price,volume\n1,x,30,3\n1,x,30\n")
    (tmp_path / "d.csv").write_text("t,price\n1,40\n")
    (tmp_path / "e.csv").write_text("")
    for points in (
        S.directory_points(spark, str(tmp_path), MAPPING, as_of_ms=NOW),
        S.csv_file_points(spark, str(tmp_path), MAPPING, strict=False, as_of_ms=NOW),
    ):
        got = sorted((r.error_code or "", r.metrics or []) for r in points.collect())
        assert got == [
            ("", [10.0, 1.0]), ("", [20.0, 2.0]), ("", [30.0, 3.0]), (P.CSV_READ_ERROR, []), (P.PARSE_ERROR, []),
        ]
    union = S.read_csv(spark, str(tmp_path))
    assert {"t", "price", "volume", "more"} <= set(union.columns) and union.count() == 5


def test_only_formats_that_are_there(spark, tmp_path):
    (tmp_path / "a.txt").write_text("t,price,volume\n1,10,1\n")
    assert S.directory_points(spark, str(tmp_path), MAPPING, as_of_ms=NOW).count() == 1
    assert {kind for _, kind in S.list_files(spark, str(tmp_path))} == {"csv"}


def test_no_cap_unless_set(spark, tmp_path):
    line = '{"t":1,"price":1,"volume":1,"pad":"' + "x" * 6_000_000 + '"}'
    (tmp_path / "a.jsonl").write_text(line + "\n")
    row = S.json_points(S.read_jsonl(spark, str(tmp_path)), MAPPING, NOW).first()
    assert row.error_code is None and row.raw == line


OPEN = GateOptions(future_tolerance_ms=10**15, stale_tolerance_ms=10**15, bounds={0: Bound(max=50.0)})


def small_folder(spark, root):
    make_tree(root)
    rows = [(1_700_000_000_000 + i, float(i), 1.0) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "t bigint, price double, volume double").coalesce(1)
    frame.write.parquet(str(root / "good"))
    frame.limit(0).write.parquet(str(root / "none"))
    frame.write.option("compression", "none").parquet(str(root / "holed"))
    [holed] = (root / "holed").glob("*.parquet")
    data = bytearray(holed.read_bytes())
    data[4:60] = b"\xff" * 56  # the first page; the footer stays whole
    for side in (root / "holed").glob(".*.crc"):
        side.unlink()
    holed.write_bytes(data)
    (root / "bad.parquet").write_text("no columns here")


def test_folder_run_survives_bad_files(spark, tmp_path):
    root, out, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")
    root.mkdir()
    small_folder(spark, root)
    got = run_folder(spark, str(root), MAPPING, OPEN, OutputOptions(format="csv"), str(out), state, as_of_ms=NOW, complete=False)
    report = {r.file_path.rsplit("/in/")[1]: r for r in spark.read.parquet(f"{out}/files").collect()}
    failed = {name.split("/")[0] for name, r in report.items() if r.failed}
    assert failed == {"bad.parquet", "holed"}
    good = [r for name, r in report.items() if name.startswith("good/")]
    assert [(r.accepted, r.dropped) for r in good if r.dropped] == [(51, 19_949)]
    assert any(name.startswith("none/") for name in report)
    accepted = spark.read.option("header", True).csv(f"{out}/accepted").count()
    dead = spark.read.text(f"{out}/dead").collect()
    assert (got["accepted"], got["dropped"], got["files"], got["failed"]) == (accepted, len(dead), len(report), 2)
    assert sum("unreadable parquet file" in r.value for r in dead) == 2
    again = run_folder(spark, str(root), MAPPING, OPEN, OutputOptions(format="csv"), str(out), state, as_of_ms=NOW)
    assert again == {"accepted": 0, "dropped": 0, "files": 0, "failed": 0}
    with pytest.raises(cursor.RunCompleted):
        run_folder(spark, str(root), MAPPING, OPEN, OutputOptions(format="csv"), str(out), state, as_of_ms=NOW)


def test_folder_run_is_repeated_without_doubles(spark, tmp_path, monkeypatch):
    root, out, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")
    root.mkdir()
    make_tree(root)
    args = (spark, str(root), MAPPING, OPEN, OutputOptions(format="csv"), str(out), state)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(cursor, "save_cursor", lost)
        with pytest.raises(OSError):
            run_folder(*args, as_of_ms=NOW)
    got = run_folder(*args, as_of_ms=NOW)
    assert spark.read.option("header", True).csv(f"{out}/accepted").count() == got["accepted"] > 0
    assert spark.read.text(f"{out}/dead").count() == got["dropped"]


def test_only_unreadable_parquet(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("nothing")
    [row] = S.directory_points(spark, str(tmp_path), MAPPING, as_of_ms=NOW).collect()
    assert (row.error_code, row.raw.rsplit("/")[-1], row.metrics) == ("FILE_READ_ERROR", "x.parquet", None)


def test_header_after_blank_lines_is_found(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "a.csv").write_text("t,price,volume\n1,10,1\n")
    (root / "b.csv").write_text("\n \r\n\nt,price,volume\n1,20,2\n1,30,3\n")
    (root / "c.csv").write_text("\n\n")
    got = S.csv_file_points(spark, str(root), MAPPING, strict=False, as_of_ms=NOW).collect()
    assert sorted(r.metrics[0] for r in got) == [10.0, 20.0, 30.0]
    done = run_folder(
        spark, str(root), MAPPING, OPEN, OutputOptions(format="csv"), str(tmp_path / "out"), str(tmp_path / "state"),
        as_of_ms=NOW,
    )
    assert done == {"accepted": 3, "dropped": 0, "files": 3, "failed": 0}


def test_reader_options_reach_header_and_rows(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("# one, two\n\n# \"\nt;price;volume\n1;10;1\n# 3;3;3\n2;'2;0';2\n")
    got = S.csv_file_points(spark, str(tmp_path / "a"), MAPPING, sep=";", as_of_ms=NOW, comment="#", quote="'")
    assert sorted((r.error_code or "", (r.metrics or [0])[0]) for r in got.collect()) == [("", 10.0), ("PARSE_ERROR", 0)]
    for encoding in ("UTF-16", "UTF-16LE", "ISO-8859-1"):
        root = tmp_path / encoding
        root.mkdir()
        (root / "x.csv").write_bytes("t,price,volume,é\n1,10,1,ü\n2,20,2,\n".encode(encoding))
        rows = S.csv_file_points(spark, str(root), MAPPING, as_of_ms=NOW, encoding=encoding, keep_unreadable=True).collect()
        assert sorted(r.metrics[0] for r in rows) == [10.0, 20.0]
        assert sorted(r.raw for r in rows)[0] == "1|10|1|ü"
        assert "é" in S.read_csv(spark, str(root), encoding=encoding).columns


def test_quoted_line_break_in_the_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text('"t","the\nprice","volume"\n1,10,1\n2,"20",2\n')
    mapping = PointMapping({"the\nprice": 0, "volume": 1}, 2, MAPPING.time)
    got = S.csv_file_points(spark, str(tmp_path), mapping, as_of_ms=NOW).collect()
    assert sorted(r.metrics[0] for r in got) == [10.0, 20.0]


@pytest.mark.parametrize("packed", [False, True])
def test_only_the_front_of_a_file_is_read(spark, tmp_path, packed):
    body = "a,b\n" + "1,2\n" * 500_000
    path = tmp_path / ("x.csv.gz" if packed else "x.csv")
    path.write_bytes(gzip.compress(body.encode()) if packed else body.encode())
    long = tmp_path / "long.csv"
    long.write_text('"' + "x" * 300_000 + '\n",b\n' + "1,2\n" * 500_000)
    rows = {r.path.rsplit("/")[-1]: r for r in S.probe(
        spark, [(str(path), "csv"), (str(long), "csv")], S.DIALECTS
    ).collect()}
    first, second = rows[path.name], rows["long.csv"]
    assert first.header == ["a", "b"] and first.bytes_read <= (path.stat().st_size if packed else 64 << 10)
    assert len(second.header[0]) == 300_001 and second.spans_lines and second.bytes_read < 1 << 20


def mixed_bad_files(spark, root):
    good = "t,price,volume\n" + "".join(f"{i},{i % 50},1\n" for i in range(20_000))
    (root / "a.csv").write_text(good)
    (root / "cut.csv.gz").write_bytes(gzip.compress(good.encode())[:20_000])
    (root / "cut.tsv.gz").write_bytes(gzip.compress(good.replace(",", "\t").encode())[:-9])
    lines = "".join(f'{{"t":{i},"price":1,"volume":2}}\n' for i in range(20_000))
    (root / "cut.jsonl.bz2").write_bytes(bz2.compress(lines.encode())[:-100])
    (root / "cut.json.gz").write_bytes(gzip.compress(b'[{"t":1,"price":1,"volume":2}]' * 50)[:30])
    (root / "whole.jsonl.gz").write_bytes(gzip.compress(lines.encode()))
    one = spark.range(100).coalesce(1)
    one.selectExpr("id t", "cast(id % 50 as double) price", "1 volume").write.parquet(str(root / "double"))
    one.selectExpr("id t", "cast(id % 50 as int) price", "1.5f volume").write.parquet(str(root / "int"))
    one.selectExpr("id t", "'x' price", "1 volume").write.parquet(str(root / "text"))
    one.selectExpr("id t", "1 volume").write.parquet(str(root / "missing"))


def test_folder_run_isolates_each_bad_file(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    root.mkdir()
    mixed_bad_files(spark, root)
    done = run_folder(
        spark, str(root), MAPPING, OPEN, OutputOptions(format="csv"), str(out), str(tmp_path / "state"), as_of_ms=NOW
    )
    report = {r.file_path.rsplit("/in/")[1].split("/")[0]: r for r in spark.read.parquet(f"{out}/files").collect()}
    failed = {"cut.csv.gz", "cut.tsv.gz", "cut.jsonl.bz2", "cut.json.gz", "text", "missing"}
    assert {name for name, r in report.items() if r.failed} == failed and done["failed"] == len(failed)
    assert {n: (r.accepted, r.dropped) for n, r in report.items() if not r.failed} == {
        "a.csv": (20_000, 0), "whole.jsonl.gz": (20_000, 0), "double": (100, 0), "int": (100, 0)
    }
    assert 0 < report["cut.csv.gz"].accepted < 20_000 and all(report[n].dropped == 1 for n in failed)
    dead = spark.read.text(f"{out}/dead").collect()
    assert len(dead) == len(failed) == done["dropped"]
    assert spark.read.option("header", True).csv(f"{out}/accepted").count() == done["accepted"]


def test_file_that_vanishes_after_the_probe(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "in", tmp_path / "out"
    root.mkdir()
    for name in ("a.csv", "b.csv", "empty.csv"):
        (root / name).write_text("t,price,volume\n" + "1,10,1\n" * (name != "empty.csv"))
    made = folder.directory_points

    def late(*args, **kwargs):
        points = made(*args, **kwargs)
        (root / "b.csv").unlink()
        return points

    monkeypatch.setattr(folder, "directory_points", late)
    done = run_folder(
        spark, str(root), MAPPING, OPEN, OutputOptions(format="csv"), str(out), str(tmp_path / "state"), as_of_ms=NOW
    )
    assert done == {"accepted": 1, "dropped": 1, "files": 3, "failed": 1}
    assert "file is gone" in spark.read.text(f"{out}/dead").first().value
