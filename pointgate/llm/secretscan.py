"""Secret scans: all rules in one automaton, all texts in one pass over their UTF-8 bytes.

The rules are compiled once to a minimal deterministic automaton (``automaton``), which is broadcast: its size depends
on the rules alone.  A task lays the texts of a batch end to end, parted by a byte that no rule takes, and passes over
the bytes once; the rare ends of matches are followed back to their starts by the reversed rule.

Finds are leftmost and do not overlap within a kind; kinds do not hide each other.  Places are code points, the end is
exclusive.  Null and empty texts have no finds; every row comes back, repeated ones each; an empty table gives none.
No shuffle.  A text of any length is taken in blocks that hand their state on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.llm.automaton import Automaton, Rule
from pointgate.llm.text import pieces, share, texts_of


def any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: Kinds of secrets in the order in which finds at one place are listed.
BASE_RULES = (
    Rule(
        "assign",
        f"({any_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?",
        tail="[A-Za-z0-9+/_.=-]",
        tail_least=6,
    ),
    Rule("access", "AKIA", tail="[A-Z0-9]", least=20),
    Rule("hex", "[0-9a-f]{23}", tail="[0-9a-f]"),
)
#: Forms of tokens that issuers publish.
MORE_RULES = (
    Rule("github", "gh[pousr]_", tail="[A-Za-z0-9]", least=40),
    Rule("slack", "xox[abprs]-", tail="[A-Za-z0-9-]", least=15),
    Rule("google", "AIza", tail="[A-Za-z0-9_-]", least=39),
    Rule("stripe", "[rs]k_live_", tail="[A-Za-z0-9]", least=24),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.]", tail="[A-Za-z0-9_-]"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<kind: string, start: long, end: long>>"


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> Automaton:
    return Automaton(rules)


def spans_of(texts: list[bytes], automaton: Automaton) -> list[list[tuple[int, int, int]]]:
    """For each text its finds as (start, rule, end) in code points, in order."""
    data = np.frombuffer(b"\xff".join([*texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begins = np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for rule, start, end in automaton.finds(data):
        found[int(np.searchsorted(begins, start, side="right")) - 1].append((start, rule, end))
    for text, begin, own in zip(texts, begins.tolist(), found):
        if not own:
            continue
        own.sort()
        places = sorted({p for start, _, end in own for p in (start, end)})
        point, last, points = 0, begin, {}
        for p in places:
            point += int(np.count_nonzero((data[last:p] & 0xC0) != 0x80))
            points[p], last = point, p
        own[:] = [(points[a], rule, points[b]) for a, rule, b in own]
    return found


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and ``spans``: the finds of every row as (kind, start, end), by start, then in the order of the rules."""
    shared = share(docs.sparkSession, compiled(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared()
        kinds = np.array([r.name for r in automaton.rules], object)
        for piece in pieces(batches):
            texts = piece.column("text").cast(pa.large_binary()).to_pylist()
            found = spans_of(texts, automaton)
            flat = np.array([f for own in found for f in own], np.int64).reshape(-1, 3)
            bounds = np.cumsum([0, *map(len, found)]).astype(np.int32)
            spans = pa.StructArray.from_arrays(
                [pa.array(kinds[flat[:, 1]], pa.string()), pa.array(flat[:, 0]), pa.array(flat[:, 2])],
                ["kind", "start", "end"],
            )
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)], ["doc_id", "spans"]
            )

    return texts_of(docs).mapInArrow(run, f"doc_id long, spans {SPANS}")


def listed(spans: Column) -> Column:
    """The spans as ``kind:start:end``, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
