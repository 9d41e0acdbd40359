"""The numeric kernels against plain definitions."""

import io
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pointgate.llm import bagminhash, decontaminate, hilbert, langid, logbilinear, packing, quality, text, warc

FILE = public_tokenizers.path("word_bpe_49k.json")


def edit_distance_inside(pattern, whole):
    before = [0] * (len(whole) + 1)
    for i, c in enumerate(pattern):
        now = [i + 1]
        for j, d in enumerate(whole):
            now.append(min(before[j] + (c != d), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_myers_is_the_smallest_edit_distance():
    draw = random.Random(1)
    for _ in range(800):
        p = "".join(draw.choice("abc") for _ in range(draw.randint(1, 80)))
        t = "".join(draw.choice("abc") for _ in range(draw.randint(0, 90)))
        assert decontaminate.myers(p, t)[0] == edit_distance_inside(p, t)


def test_every_occurrence_within_the_budget_is_found():
    draw = random.Random(2)
    item = " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(30))
    matcher = decontaminate.Matcher([(7, item), (8, ""), (9, None or "short")], 0.08)
    budget = int(len(item) * 0.08)
    for errors in range(budget + 1):
        changed = list(item)
        for place in draw.sample(range(len(item)), errors):
            changed[place] = draw.choice(["", "z", changed[place] + "y"])
        whole = "before " + "".join(changed) + " after"
        plain = decontaminate.normal(whole)
        hits = [h for h in matcher.hits(whole) if h[0] == 7]
        if edit_distance_inside(item, plain) <= budget:
            assert len(hits) == 1
            _, start, end, distance = hits[0]
            assert distance == edit_distance_inside(item, plain) == edit_distance_inside(item, plain[start:end])
    assert matcher.hits("nothing of it") == []
    assert [h[0] for h in matcher.hits("a Short\nb")] == [9]


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours_touch(dimensions, bits):
    axes = [np.arange(1 << bits)] * dimensions
    grid = np.stack(np.meshgrid(*axes, indexing="ij"), -1).reshape(-1, dimensions)
    keys = hilbert.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert set(np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)) == {1}


def test_bagminhash_estimates_weighted_jaccard():
    draw, wrong = np.random.default_rng(0), []
    for _ in range(40):
        n = int(draw.integers(3, 60))
        elements = draw.integers(0, 1 << 60, n).astype(np.uint64)
        a = draw.integers(0, 9, n)
        b = np.where(draw.random(n) < 0.6, a, draw.integers(0, 9, n))
        a[0] = b[0] = 1
        made = bagminhash.signatures(
            np.concatenate([elements[a > 0], elements[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]),
            np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()]), 2, 1024,
        )
        wrong.append((made[0] == made[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(wrong)) < 0.01 and np.std(wrong) < 0.025
    assert (bagminhash.signatures(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 2, 8) == 2**32 - 1).all()


@pytest.mark.parametrize("cache", [3, 300_000])
def test_token_ids_equal_the_tokenizer(cache):
    known = packing.WordTokens(open(FILE, encoding="utf-8").read(), packing.PackOptions(cache_words=cache))
    plain = Tokenizer.from_file(FILE)
    cases = ["", "  ", "It's I'll 've THE.End, a.b x.. ..", "<|endoftext|> x<|ENDOFTEXT|>a <|startoftext|>",
             "İstanbul ΣΑΣ. é. áb, ﬁn 12.5, ①② x \x85z \x1cq", "B! É! ÉA. ×. a× İ. ß? ª. x÷ ǅ. 日本。 a b.", "The the THE."]
    for _ in range(2):
        bounds, ids, _ = packing.token_rows(pa.array(cases, pa.large_string()), known, packing.PackOptions())
        for k, case in enumerate(cases):
            expected = plain.encode(case, add_special_tokens=False).ids + [1]
            assert ids[bounds[k] : bounds[k + 1]].tolist() == expected


@pytest.mark.parametrize("total", [0, 1, 5, 2048, 5000, 5396])
def test_cuts_leave_only_full_or_power_of_two_sequences(total):
    at, used = 0, {}
    for count in (3, 1, 2000, 7, 3000, 400, 10**6):
        count = min(count, total - at)
        for begin, size, sequence, offset in packing.cuts(at, count, total, 2048):
            assert used.setdefault(sequence, 0) == offset and size > 0
            used[sequence] += size
        at += count
    assert sum(used.values()) == total
    assert all(v == 2048 or v & (v - 1) == 0 for v in used.values())


def test_log_table_is_normalised_and_learns():
    draw = np.random.default_rng(3)
    triples = draw.integers(0, 6, (300, 3))
    triples[:, 2] = triples[:, 1]  # the class repeats the one before
    allowed = np.array([True] * 6 + [False])
    model = logbilinear.LogBilinear(7, 8).fit(triples, np.ones(len(triples), np.int64), steps=300, batch=256, noise=8)
    table = model.log_table(allowed)
    assert np.allclose((10**table).sum(axis=2), 1, atol=1e-4) and np.isneginf(table[:, :, 6]).all()
    assert all(table[0, v].argmax() == v for v in range(6))


def test_profiles_by_hand():
    table = langid.letter_table()
    points = langid.letters("A, a b!", table)
    assert points.tolist() == [1, 97, 1, 97, 1, 98, 1]
    keys = langid.grams(points)
    assert (keys == 97).sum() == 2 and (keys == ((1 << 21) | 97)).sum() == 2 and len(keys) == 12
    learned = langid.local_profiles(["aaa aa", "bbb bb"], ["x", "y"], 10)
    assert learned.predict(langid.letters("aa", table))[0] == "x"
    assert learned.predict(langid.letters("12 !", table)) == ("und", 0.0)


def test_quality_vectors_have_length_one():
    bounds, places, values = quality.vectors(pa.array(["", "a b a b", "x"], pa.large_string()), 18)
    assert bounds[0] == bounds[1] == 0
    for a, b in zip(bounds[1:-1], bounds[2:]):
        assert np.isclose((values[a:b].astype(float) ** 2).sum(), 1)


def test_split_words_of_slices():
    whole = pa.array(["x à b", " é c\x0bd ", "", "à"], pa.string())
    for begin in range(4):
        part = text.fresh(whole.slice(begin).cast(pa.large_string()))
        offsets, codes, distinct = text.split_words(part)
        words = [[distinct[c] for c in codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
        assert words == [["x", "à", "b"], ["é c", "d"], [], ["à"]][begin:]


def test_bundle_round_trip_by_seek_table():
    stream = io.BytesIO()
    writer = warc.BundleWriter(stream, warc.WarcOptions(frame_bytes=600))
    payloads = [b"", b"x" * 2000, "é\r\n\r\nWARC/1.1".encode()] * 3
    places = []
    for k, payload in enumerate(payloads):
        refers = warc.identifier(1, 1) if k > 3 and payload == payloads[1] else None
        made = warc.record(warc.identifier(k, k), "http://a/\r\nX: y", payload, warc.digest_of(payload), refers, "1970-01-01T00:00:00Z")
        places.append(writer.add(made))
    writer.finish()
    size = stream.tell()
    frames = warc.seek_table(stream, size)
    assert len(frames) == len({f for f, _ in places}) > 3
    for k in reversed(range(len(payloads))):
        fields, block, _ = warc.parse(warc.read_frame(stream, frames[places[k][0]]), places[k][1])
        _, length, digest, kind, refers = warc.outcome(fields, block, k)
        assert (length, digest) == (len(payloads[k]), warc.digest_of(payloads[k]))
        assert (kind, refers) == (("revisit", 1) if k > 3 and payloads[k] == payloads[1] else ("response", None))
