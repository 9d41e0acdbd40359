"""The wire decoder against a plain reader, byte by byte."""

import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pointgate.operators import points as P
from pointgate.sources.wire import decoded, wire_points

NOW = 1_700_000_000_000


def varint(n):
    n &= 2**64 - 1
    out = b""
    while n >= 0x80:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def field(number, wire, body=b""):
    return varint(number << 3 | wire) + body


def moment(ns):
    return field(1, 0, varint(ns))


def packed(*values):
    return field(2, 2, varint(8 * len(values)) + struct.pack(f"<{len(values)}d", *values))


def single(value):
    return field(2, 1, struct.pack("<d", value))


def plain(data):
    """(time, metrics) or None, one field after the other."""
    at, groups, ns, metrics = 0, [], 0, []

    def number():
        nonlocal at
        value = 0
        for k in range(10):
            if at >= len(data):
                raise ValueError
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << 7 * k
            if byte < 0x80:
                return value & (2**64 - 1)
        raise ValueError

    def take(size):
        nonlocal at
        if at + size > len(data):
            raise ValueError
        at += size
        return data[at - size : at]

    try:
        while at < len(data):
            tag = number()
            n, wire = tag >> 3, tag & 7
            if n == 0 or wire > 5:
                raise ValueError
            if not groups and (n == 1 and wire != 0 or n == 2 and wire not in (1, 2)):
                raise ValueError
            if wire == 0:
                value = number()
                ns = value if n == 1 and not groups else ns
            elif wire == 1:
                body = take(8)
                metrics += struct.unpack("<d", body) if n == 2 and not groups else []
            elif wire == 5:
                take(4)
            elif wire == 2:
                body = take(number())
                if n == 2 and not groups:
                    if len(body) % 8:
                        raise ValueError
                    metrics += struct.unpack(f"<{len(body) // 8}d", body)
            elif wire == 3:
                groups.append(n)
            elif not groups or groups.pop() != n:
                raise ValueError
        if groups:
            raise ValueError
    except ValueError:
        return None
    return ns - 2**64 if ns >= 2**63 else ns, metrics


def pairs(messages):
    return [
        None if r is None or r["problem"] else (r["timestamp_ns"], r["metrics"])
        for r in decoded(pa.array(messages, pa.binary())).to_pylist()
    ]


FIELDS = [
    moment(42), moment(-1), moment(2**63 - 1), moment(0), packed(1.25, 2.0), packed(), packed(*map(float, range(40))), single(-0.0),
    single(3.5), field(3, 0, varint(2**64 - 1)), field(9, 2, varint(3) + b"abc"), field(2**28, 5, b"1234"),
    field(7, 1, b"12345678"), field(4, 3) + moment(7) + single(9.0) + field(4, 4), field(5, 3) + field(5, 3) + field(5, 4) + field(5, 4),
]


def test_known_messages():
    assert pairs([moment(42) + packed(1.25, 2.0, 3.5), b"", packed(1.0) + moment(9) + single(2.0) + moment(10)]) == [
        (42, [1.25, 2.0, 3.5]), (0, []), (10, [1.0, 2.0])
    ]
    assert decoded(pa.array([None, moment(1)], pa.binary())).to_pylist()[0]["timestamp_ns"] is None


@pytest.mark.parametrize("seed", range(6))
def test_equals_plain_reader(seed):
    make = random.Random(seed)
    messages = []
    for _ in range(400):
        data = b"".join(make.choices(FIELDS, k=make.randrange(8)))
        damage = make.randrange(4)
        if damage == 1:
            data = data[: make.randrange(len(data) + 1)]
        elif damage == 2 and data:
            at = make.randrange(len(data))
            data = data[:at] + bytes([make.randrange(256)]) + data[at + 1 :]
        elif damage == 3:
            data = make.randbytes(make.randrange(30))
        messages.append(data)
    got, want = pairs(messages), [plain(m) for m in messages]
    assert repr(got) == repr(want)  # NaN included
    assert None in want and any(w and w[1] for w in want)
    whole = pa.array(messages, pa.binary())
    assert repr(decoded(whole.slice(37, 90)).to_pylist()) == repr(decoded(whole).to_pylist()[37:127])


def test_points_and_dead_letters(spark):
    rows = [(1, moment(42) + packed(1.0, 2.0)), (2, packed(5.0)), (3, moment(1)), (4, moment(-5) + single(1.0)),
            (5, b"\x08"), (6, None), (7, b"\x11" + b"0" * 7)]
    df = spark.createDataFrame(rows, "id int, body binary").withColumn("metrics", F.lit("clash"))
    got = {r.id: r for r in wire_points(df, "body", NOW).collect()}
    assert set(got) == {1, 2, 4, 5, 6, 7}  # no metrics: skipped
    assert (got[1].timestamp_ns, got[1].metrics) == (42, [1.0, 2.0])
    assert got[2].timestamp_ns == NOW * 10**6 and got[4].error_code == P.BAD_TIMESTAMP
    assert [got[k].error_code for k in (5, 6, 7)] == [P.PARSE_ERROR] * 3
    assert (got[5].raw, got[6].raw, got[5].parse_error) == ("08", "", "message ends inside a field")
    assert wire_points(df.where("false"), "body", NOW).count() == 0
