"""Secret scans against plain regular expressions, and the automaton's compiler."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from pointgate.llm import queries
from pointgate.llm.automaton import Automaton, Rule
from pointgate.llm.secretscan import RULES, compiled, secret_spans, spans_of
from tests.llm.conftest import ODD

DATA = "/root/testdata/sf0.01"

PLAIN = {
    "assign": (r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "github": (r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    "google": (r"AIza[A-Za-z0-9_-]+", 0, 39),
    "stripe": (r"[rs]k_live_[A-Za-z0-9]+", 0, 24),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+", 0, 0),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
}
PARTS = [
    "password", "PassWd", "secret", "token", "apikey", "API_key", "=", "==", ":", " ", '"', "'", "AKIA", "ABC123XYZ0",
    "0123456789abcdef", "dead", "é", "日", "abc", "xoxb-", "ghp_", "AIza", "sk_live_", "\n", "-----BEGIN ", "RSA ",
    "PRIVATE KEY-----", "eyJ", ".", "aaaaaaaa", "Zz09", "K",
]


def plain(text):
    out = []
    for k, (kind, (pattern, group, least)) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.mark.parametrize("lane,block,few", [(7, 50, 1), (64, 1000, 24), (1024, 1 << 20, 3)])
def test_equals_plain_expressions(lane, block, few):
    automaton = compiled(RULES)
    automaton.LANE, automaton.BLOCK, automaton.FEW = lane, block, few
    make = random.Random(lane)
    for _ in range(60):
        texts = ["".join(make.choices(PARTS, k=make.randrange(60))) for _ in range(20)] + [""]
        for text, found in zip(texts, spans_of([t.encode() for t in texts], automaton)):
            assert found == plain(text), text
    for name in ("LANE", "BLOCK", "FEW"):
        delattr(automaton, name)


def test_consumed_matches_hide_what_lies_in_them():
    text = "password=token: abcdefgh token=abc api_key='hij-klm'"
    assert plain(text) == spans_of([text.encode()], compiled(RULES))[0]
    assert [text[a:b] for a, _, b in plain(text)] == ["api_key='hij-klm"]


def test_long_runs_in_one_text():
    text = b"password=" + b"A" * 400_000 + b" " + b"0a" * 300_000 + "é".encode() * 10 + b" token=secret=x"
    ends = [(0, 0, 400_009), (400_010, 2, 1_000_010), (1_000_021, 0, 1_000_035)]
    assert spans_of([text], compiled(RULES))[0] == ends


def test_compiler_refuses_what_needs_to_look_back():
    for rule in (Rule("x", "a*"), Rule("x", "abcd|b"), Rule("x", "a(bc)?"), Rule("x", "a|b"), Rule("x", "(a")):
        with pytest.raises(ValueError):
            Automaton((rule,))
    (only,) = spans_of([b"xaab aab b"], Automaton((Rule("x", "a{2}(b|c){0,1}", tail="b"),)))
    assert only == [(1, 0, 4), (5, 0, 8)]


def test_states_are_minimal():
    one = Automaton((Rule("x", "(cat|bat|rat)", tail="s"),))
    assert len(one.codes) == 5  # nothing yet, first letter, second, third, found


def test_odd_rows(odd, nothing):
    assert secret_spans(nothing).count() == 0
    got = secret_spans(odd).collect()
    assert len(got) == len(ODD) and all(r.spans == [] for r in got)
    text = "é token: 'abcdef12' and " + "ab12" * 8
    docs = odd.select(*[F.lit(text).alias("text") if c == "text" else F.col(c) for c in odd.columns])
    for r in secret_spans(docs.withColumn("spans", F.lit("clash"))).collect():
        assert [(s.kind, s.start, s.end) for s in r.spans] == [("assign", 2, 18), ("hex", 24, 56)]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.op11_secrets(spark, DATA).collect()
    names = list(PLAIN)
    for r in got:
        found = plain(texts[r.doc_id] or "")
        spans = [f"{names[k]}:{a}:{b}" for a, k, b in found]
        base = ",".join(s for s, (_, k, _) in zip(spans, found) if k < 3)
        assert r.spans == ",".join(spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in found) for n in range(3))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{DATA}/documents.parquet')")
    columns = got[0].__fields__
    want = con.execute(f"select {', '.join(columns)} from ({queries.ORACLES['op11_secrets']})").fetchall()
    same = sorted(map(tuple, got)) == sorted(want)
    assert same and any(r.spans for r in got)
