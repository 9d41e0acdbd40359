"""Scores held against slow and plain versions of the same definitions."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pointgate.llm import decontaminate, langid, lm, quality, samples, toxicity
from pointgate.llm.text import hash_words, mix

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def crc(i):
    return zlib.crc32(str(i).encode())


# quality ------------------------------------------------------------------------------------------------------


def quality_vector(text, bits):
    """place -> value, word by word."""
    one = lambda x: int(mix(np.array([x % 2**64], np.uint64))[0])
    words = words_of(text)
    lower = [int(hash_words([w.lower()], 1)[0]) for w in words]
    shapes = [int(hash_words([quality.shape(w)], 2)[0]) for w in words]
    keys = lower + shapes
    for a, b in zip(lower, lower[1:]):
        keys += [one(a * 3 + b), one(int(a == b) + 7)]
    keys += [one(a * 5 + b) for a, b in zip(shapes, shapes[1:])]
    counts = collections.Counter(k >> (64 - bits) for k in keys)
    values = {k: math.log1p(n) for k, n in counts.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {k: v / length for k, v in values.items()}


def test_quality_is_a_sparse_dot_product(table, texts):
    options = quality.QualityOptions()
    sample = samples.labelled_sample(
        table("documents"), table("labels"), "quality", 5, 0, options.max_rows, options.max_chars
    )
    weights, intercept = quality.train(sample["text"].tolist(), sample["label"].to_numpy(dtype=np.float64), options)
    got = {r.doc_id: r for r in quality.quality_scores(table("documents"), table("labels")).collect()}
    for i, text in texts.items():
        total = intercept + sum(float(weights[k]) * v for k, v in quality_vector(text, options.bits).items())
        assert math.isclose(got[i].score, 1 / (1 + math.exp(-total)), abs_tol=1e-5)
        assert got[i].predicted == int(got[i].score >= 0.3) and got[i].held_out == (crc(i) % 5 == 0)


# language -----------------------------------------------------------------------------------------------------


def profile(texts, size):
    counts = collections.Counter()
    for text in texts:
        for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower())):
            marked = f"\1{word}\1"
            counts.update(word)
            counts.update(marked[k : k + 2] for k in range(len(marked) - 1))
            counts.update(marked[k : k + 3] for k in range(len(marked) - 2))
    return [g for g, _ in sorted(counts.items(), key=lambda kv: (-kv[1], key_of(kv[0])))[:size]]


def key_of(gram):
    total = 0
    for c in gram:
        total = total << 21 | ord(c)
    return total


def test_language_is_the_nearest_profile(table, texts):
    docs = table("documents")
    langs = {r.doc_id: r.lang for r in docs.collect()}
    options = langid.LangOptions()
    learned = {
        lang: profile([texts[i] for i in texts if langs[i] == lang and crc(i) % 4 != 2], options.profile_size)
        for lang in sorted({v for v in langs.values() if v is not None})
    }
    ranks = {lang: {g: k for k, g in enumerate(p)} for lang, p in learned.items()}
    for r in langid.identify(docs).collect():
        own = profile([texts[r.doc_id]], options.profile_size)
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        far = {
            lang: sum(abs(rank[g] - k) if g in rank else options.profile_size for k, g in enumerate(own))
            for lang, rank in ranks.items()
        }
        best, second = sorted(far.values())[:2]
        assert far[r.lang_pred] == best
        assert math.isclose(r.score, second / (best + second), abs_tol=1e-9)


# toxicity -----------------------------------------------------------------------------------------------------


def test_toxicity_is_a_convolution_with_max_pooling(table, texts):
    options = toxicity.ToxicityOptions(epochs=2)
    network = toxicity.fitted(table("documents"), table("labels"), options)
    chosen = [texts[i] for i in sorted(texts)[:60]] + ["", "one", "two words", "Three. (odd) WORDS!"]
    got = network.raw(pa.array(chosen, pa.large_string()))
    for text, answer in zip(chosen, got):
        rows = [network.embeddings[toxicity.places_of([w], options.bits)[0]].sum(axis=0) for w in words_of(text)]
        zero = np.zeros(options.width, np.float32)
        pooled = []
        for k, weight in enumerate(network.filters):
            for f in range(options.filters):
                found = [
                    sum(float((rows[p + s] if p + s < len(rows) else zero) @ weight[s][:, f]) for s in range(len(weight)))
                    + float(network.biases[k * options.filters + f])
                    for p in range(len(rows))
                ]
                pooled.append(max([0.0, *found]))
        want = float(np.dot(pooled, network.output)) + network.output_bias
        assert math.isclose(float(answer), want, rel_tol=1e-3, abs_tol=1e-3)


# benchmark decontamination -------------------------------------------------------------------------------------


def edit_distance_inside(pattern, text):
    """Smallest edit distance of the pattern to any part of the text, by the plain table."""
    row = np.zeros(len(text) + 1, np.int64)
    letters = np.array([ord(c) for c in text], np.int64)
    ramp = np.arange(len(text) + 1)
    for k, c in enumerate(pattern, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + (letters != ord(c)))
        row = np.minimum.accumulate(np.concatenate([[k], best]) - ramp) + ramp  # insertions along the row
    return int(row.min())


def leaking(texts, items, rate=0.08):
    return {
        (i, k) for i, t in texts.items() for k, item in items.items()
        if item and edit_distance_inside(item, decontaminate.normal(t)) <= int(len(item) * rate)
    }


def test_leaks_in_both_directions(spark):
    make = np.random.default_rng(5)
    words = ["".join(make.choice(list("abcdefghij"), make.integers(2, 9))) for _ in range(300)]
    text = lambda n: " ".join(make.choice(words, n))
    items = {k: text(int(make.integers(2, 30))) for k in range(12)}
    texts = {}
    for i in range(150):
        item = list(items[i % 12])
        budget = int(len(item) * 0.08)
        for _ in range(max(0, budget + int(make.integers(-2, 3)))):  # about the budget, on either side
            at = int(make.integers(len(item)))
            kind = int(make.integers(3))
            item[at : at + (kind > 0)] = [str(make.choice(list("abcdefghij xyz")))] * (kind < 2)
            item = item or ["a"]
        texts[i] = f"{text(int(make.integers(0, 40)))} {''.join(item).upper()}\n{text(int(make.integers(0, 40)))}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = leaking(texts, {k: decontaminate.normal(v) for k, v in items.items()})
    assert 30 < len(want) < 140
    for kind, name in (("smallint", lambda k: k), ("string", str), ("decimal(9,2)", lambda k: k), ("date", None)):
        rows = spark.createDataFrame(list(items.items()), "item_id long, text string")
        if kind == "date":
            rows = rows.withColumn("item_id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("item_id").cast("int")))
        else:
            rows = rows.withColumn("item_id", F.col("item_id").cast(kind))
        hits = decontaminate.leaks(docs, rows, decontaminate.LeakOptions(block_chars=300))
        assert hits.schema["item_id"].dataType == rows.schema["item_id"].dataType
        if kind == "date":
            hits = hits.withColumn("item_id", F.date_diff("item_id", F.lit("2020-01-01")))
        assert {(r.doc_id, int(r.item_id)) for r in hits.select("doc_id", "item_id").distinct().collect()} == want
    kept = {r.doc_id for r in decontaminate.without_leaks(docs, rows).collect()}
    assert kept == set(texts) - {i for i, _ in want}


# language model ------------------------------------------------------------------------------------------------


def test_lm_scores_are_sums_of_class_and_token_probabilities(spark, table, texts, monkeypatch):
    """The model's table is taken as fitted; everything around it is counted again by plain means."""
    kept = {}
    usual = lm.LogBilinear.log_table

    class Spy(lm.LogBilinear):
        def fit(self, triples, counts, *args, **kwargs):
            kept["triples"], kept["counts"], kept["network"] = triples, counts, self
            return super().fit(triples, counts, *args, **kwargs)

    monkeypatch.setattr(lm, "LogBilinear", Spy)
    options = lm.LmOptions(chunk_chars=60_000, steps=40)
    got = {r.doc_id: r for r in lm.lm_scores(table("documents"), options).collect()}
    tokens = {i: [w.translate(FOLD) for w in words_of(t)] for i, t in texts.items()}
    learned = [i for i in texts if crc(i) % 7 != 2]
    count = collections.Counter(w for i in learned for w in tokens[i])
    frequent = {w: k for k, (w, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0].encode()))[: options.frequent])}

    def class_of(w):
        if w in frequent:
            return frequent[w]
        return options.frequent + 1 + xxhash.xxh64_intdigest(w[-2:].encode(), 42) % 2**31 % options.shared

    triples = collections.Counter()
    for i in learned:
        row = [options.before] * 2 + [class_of(w) for w in tokens[i]] + [options.end]
        triples.update(zip(row, row[1:], row[2:]))
    assert triples == {tuple(map(int, t)): int(n) for t, n in zip(kept["triples"], kept["counts"])}
    totals, kinds = collections.Counter(), collections.Counter()
    for w, n in count.items():
        totals[class_of(w)] += n
        kinds[class_of(w)] += 1
    allowed = np.arange(options.classes) != options.before
    log = usual(kept["network"], allowed)
    assert np.allclose((10.0**log).sum(axis=2), 1, atol=1e-4)
    for i in texts:
        row = [options.before] * 2 + [class_of(w) for w in tokens[i]] + [options.end]
        score = sum(float(log[a, b, c]) for a, b, c in zip(row, row[1:], row[2:]))
        for w in tokens[i]:
            if w not in frequent:
                k = class_of(w)
                score += math.log10((count[w] + 1) / (totals[k] + kinds[k] + 1))
        assert math.isclose(got[i].score, score, rel_tol=1e-4, abs_tol=1e-3)


def test_lm_of_repeated_rows_without_ids(spark):
    """Copies that share id and text are scored each, over several chunks, and never learned from."""
    rows = [(None, "the same text again")] * 40 + [(k, f"a text of its own {k} the same") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.lm_scores(docs, lm.LmOptions(chunk_chars=200, steps=20)).collect()
    assert len(got) == 80 and len({(r.score, r.base_score) for r in got if r.doc_id is None}) == 1
    learned = [t for i, t in rows if i is not None and crc(i) % 7 != 2]
    assert {r.train_tokens for r in got} == {sum(len(t.split()) + 1 for t in learned)}


@pytest.mark.parametrize("distance,pattern,text", [(0, "abc", "xxabcxx"), (1, "abc", "xxacxx"), (2, "abcd", "xadx"), (3, "abc", "")])
def test_plain_distance(distance, pattern, text):
    assert edit_distance_inside(pattern, text) == distance == decontaminate.myers(pattern, text)[0]
