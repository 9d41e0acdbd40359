"""Typed points in their wire form: ``int64 timestamp_ns = 1; repeated double metrics = 2`` as protocol buffer bytes.

All messages of an Arrow batch are decoded side by side: each step reads one field of every message that has bytes
left, so the number of steps is that of the longest message's fields, not of the messages.  Doubles may be packed or
not, fields may come in any order, the last time wins, unknown fields are skipped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.operators import normalize as N
from pointgate.operators import points as P
from pointgate.session import ship_package

POINT = "struct<timestamp_ns: bigint, metrics: array<double>, problem: string>"
#: Numbers of the wire types.
VARINT, FIXED64, BYTES, GROUP, GROUP_END, FIXED32 = range(6)
_PROBLEMS = np.array([None, "message ends inside a field", "number of more than ten bytes", "field number 0",
                      "field of another type", "unknown wire type", "group is not closed"], object)
_CUT, _LONG, _ZERO, _TYPE, _WIRE, _OPEN = range(1, 7)


class _Messages:
    """Cursors into the bytes of many messages; a message with a problem stands still at its end."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        self.data = np.append(data, np.uint8(0))  # a cursor at the very end reads something
        self.at, self.ends = begins.copy(), ends
        self.problem = np.zeros(len(begins), np.int8)

    def fail(self, which: np.ndarray, code: int) -> None:
        self.problem[which] = code
        self.at[which] = self.ends[which]

    def varint(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The messages whose number is whole, and the numbers."""
        value, open_ = np.zeros(len(which), np.uint64), np.arange(len(which))
        for step in range(10):
            rows = which[open_]
            cut = self.at[rows] >= self.ends[rows]
            self.fail(rows[cut], _CUT)
            open_, rows = open_[~cut], rows[~cut]
            byte = self.data[self.at[rows]].astype(np.uint64)
            value[open_] |= (byte & np.uint64(0x7F)) << np.uint64(7 * step)
            self.at[rows] += 1
            open_ = open_[byte >= 0x80]
            if not len(open_):
                break
        self.fail(which[open_], _LONG)
        good = self.problem[which] == 0
        return which[good], value[good]

    def skip(self, which: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Move on by so many bytes; the messages that have them."""
        fits = sizes <= (self.ends[which] - self.at[which]).astype(np.uint64)
        self.fail(which[~fits], _CUT)
        self.at[which[fits]] += sizes[fits].astype(np.int64)
        return fits


def decode_points(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list, np.ndarray]:
    """Times, (message, first byte, number) of the runs of doubles in order of their fields, and problem codes."""
    m = _Messages(data, begins, ends)
    moments = np.zeros(len(begins), np.int64)
    runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    groups: dict[int, list[int]] = {}  # numbers of the groups a message is in; rare
    while len(rows := np.flatnonzero(m.at < m.ends)):
        rows, tags = m.varint(rows)
        number, wire = tags >> np.uint64(3), (tags & np.uint64(7)).astype(np.int64)
        m.fail(rows[number == 0], _ZERO)
        inside = np.isin(rows, list(groups)) if groups else np.zeros(len(rows), bool)
        wrong = ~inside & (((number == 1) & (wire != VARINT)) | ((number == 2) & (wire != FIXED64) & (wire != BYTES)))
        m.fail(rows[wrong], _TYPE)
        m.fail(rows[wire > FIXED32], _WIRE)
        live = m.problem[rows] == 0
        rows, number, wire, inside = rows[live], number[live], wire[live], inside[live]
        of = np.where(inside, 0, number)  # fields inside a group are nobody's

        at = np.flatnonzero(wire == VARINT)
        kept, value = m.varint(rows[at])
        mine = np.isin(kept, rows[at][of[at] == 1])
        moments[kept[mine]] = value[mine].view(np.int64)

        for kind, size in ((FIXED64, 8), (FIXED32, 4)):
            at = np.flatnonzero(wire == kind)
            begin = m.at[rows[at]].copy()
            fits = m.skip(rows[at], np.full(len(at), size, np.uint64))
            if kind == FIXED64:
                mine = fits & (of[at] == 2)
                runs.append((rows[at][mine], begin[mine], np.ones(int(mine.sum()), np.int64)))

        at = np.flatnonzero(wire == BYTES)
        packed = rows[at][of[at] == 2]
        kept, size = m.varint(rows[at])
        begin = m.at[kept].copy()
        fits = m.skip(kept, size)
        mine = fits & np.isin(kept, packed)
        uneven = mine & (size % np.uint64(8) != 0)
        m.fail(kept[uneven], _CUT)
        mine &= ~uneven
        runs.append((kept[mine], begin[mine], (size[mine] // np.uint64(8)).astype(np.int64)))

        for row, n in zip(rows[wire == GROUP].tolist(), number[wire == GROUP].tolist()):
            groups.setdefault(row, []).append(n)
        for row, n in zip(rows[wire == GROUP_END].tolist(), number[wire == GROUP_END].tolist()):
            if groups.get(row, [None])[-1] != n:
                m.fail(np.array([row]), _OPEN)
                groups.pop(row, None)
                continue
            groups[row].pop()
            if not groups[row]:
                del groups[row]
    left = np.array([r for r in groups if m.problem[r] == 0], np.int64)
    m.problem[left] = _OPEN
    return moments, runs, m.problem


def decoded(messages: pa.Array) -> pa.Array:
    """BINARY -> ``POINT``; a null message has a null time."""
    column = messages.combine_chunks() if isinstance(messages, pa.ChunkedArray) else messages
    column = pa.concat_arrays([column.cast(pa.large_binary()), pa.array([], pa.large_binary())])
    count = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + count + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    moments, runs, problem = decode_points(data, offsets[:-1].copy(), offsets[1:].copy())
    owner, begin, many = (np.concatenate([r[k] for r in runs] or [np.zeros(0, np.int64)]) for k in range(3))
    good = problem[owner] == 0
    owner, begin, many = owner[good], begin[good], many[good]
    order = np.argsort(owner, kind="stable")  # fields of a message stay in their order
    owner, begin, many = owner[order], begin[order], many[order]
    first = np.cumsum(many) - many
    place = np.repeat(begin - 8 * first, many) + 8 * np.arange(int(many.sum()))
    raw = data[(place[:, None] + np.arange(8)).ravel()] if len(place) else np.zeros(0, np.uint8)
    values = np.ascontiguousarray(raw).view("<f8")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, many, count).astype(np.int64))])
    absent = ~np.asarray(column.is_valid())
    return pa.StructArray.from_arrays(
        [
            pa.array(moments, pa.int64(), mask=absent | (problem != 0)),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.float64())),
            pa.array(_PROBLEMS[problem], pa.string()),
        ],
        ["timestamp_ns", "metrics", "problem"],
    )


def wire_point(message: Column) -> Column:
    """The decoded point of a BINARY column, as a struct of its time, its metrics and what is wrong with it."""
    ship_package()

    @F.arrow_udf(POINT)
    def decode(column: pa.Array) -> pa.Array:
        return decoded(column)

    return decode(message)


def wire_points(df: DataFrame, message: str = "value", as_of_ms: int | None = None) -> DataFrame:
    """BINARY messages -> points: as ``normalize_typed_points``; damaged and null messages are rejected, their raw form
    is their bytes in hexadecimal."""
    points = df.withColumn("__wire", wire_point(F.col(f"`{message}`")))
    points = points.withColumns({"__ns": F.col("__wire.timestamp_ns"), "__list": F.col("__wire.metrics")})
    bad = F.col("__wire.problem").isNotNull() | F.col("__ns").isNull()
    good = N.normalize_typed_points(points.filter(~bad), "__ns", "__list", as_of_ms)
    lost = P.with_point(
        points.filter(bad),
        F.lit(None).cast("bigint"),
        F.lit(None).cast("array<double>"),
        F.coalesce(F.lower(F.hex(f"`{message}`")), F.lit("")),
        parse_error=F.coalesce("__wire.problem", F.lit("no message")),
    )
    return good.drop("__wire", "__ns", "__list").unionByName(lost.drop("__wire", "__ns", "__list"))
