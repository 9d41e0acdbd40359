import pytest
from pyspark.sql import functions as F

from pointgate.functions import json as J
from pointgate.functions.numbers import strict_double


def texts(spark, *values):
    return spark.createDataFrame([(t,) for t in values], "t string").coalesce(1)


def parsed(spark, *values):
    df = texts(spark, *values).withColumn("doc", J.parse_document(F.col("t")))
    return df.withColumns({"ok": J.is_document("doc"), "v": F.try_variant_get("doc", J.ROOT, "variant")})


@pytest.mark.parametrize(
    "text,valid",
    [
        ('{"a":1}', True),
        ("  [1, 2] ", True),
        ("5", True),
        ("null", True),
        ('{"a":1} x', False),
        ('{"a":1}] x', False),
        ("1,2", False),
        ('{"a":1},{"b":2}', False),
        ('{"a":1},"b":2', False),
        ('1,"b":2', False),
        ('{"a":1}}', False),
        ('"a', False),
        ('{"a":NaN}', False),
        ("", False),
        ("NaN", False),
        ("01", False),
        ("{'a':1}", False),
        ('{"a":1', False),
    ],
)
def test_strict_documents(spark, text, valid):
    assert parsed(spark, text).first().ok is valid
    assert J.with_json_fields(texts(spark, text), F.col("t"), {"x": "a"}).first()["__ok"] is valid


def test_null_text(spark):
    assert parsed(spark, None).first().ok is False


def one(spark, text, path, index_only=False):
    df = J.with_json_fields(texts(spark, text), F.col("t"), {"x": path}, index_only=index_only)
    return df.select(strict_double(F.col("x"))).first()[0]


def test_paths(spark):
    text = '{"a":{"b":[{"c":1.5}]},"0":{"1":2},"sp ace":"3e1","q":[[7]]}'
    assert one(spark, text, "a.b.0.c") == 1.5
    assert one(spark, text, "0.1") == 2
    assert one(spark, text, "sp ace") == 30
    assert one(spark, text, "q.0.0") == 7
    assert one(spark, text, "a.b.c") is None
    assert one(spark, text, "a.b.1.c") is None


def test_index_only(spark):
    assert one(spark, '{"a":{"0":1}}', "a.0") == 1
    assert one(spark, '{"a":{"0":1}}', "a.0", index_only=True) is None
    assert one(spark, '{"a":[1]}', "a.0", index_only=True) == 1


def test_root_list(spark):
    assert one(spark, "[4, 5]", "1") == 5


@pytest.mark.parametrize("value", ["true", "null", "[1]", '{"x":1}', '"x"', '" 1"', '"1d"'])
def test_not_a_number(spark, value):
    assert one(spark, '{"v":' + value + "}", "v") is None


def test_last_duplicate_wins(spark):
    assert one(spark, '{"v":1,"v":2}', "v") == 2


def test_long_numbers(spark):
    assert one(spark, '{"v":0.1}', "v") == 0.1
    assert one(spark, '{"v":123456789012345678901234567890}', "v") == 123456789012345678901234567890.0
    assert one(spark, '{"v":1e400}', "v") == float("inf")


def test_unsigned(spark):
    values = {"5": 5, "-5": None, "5.0": None, "5.5": None, '"5"': None, "0": 0, "true": None, "1e400": None, "null": None}
    rows = parsed(spark, *values).select("t", J.unsigned(F.col("v")).alias("n")).collect()
    assert {r.t: r.n for r in rows} == values


def test_values_tell_null_from_absent(spark):
    df = J.with_json_fields(texts(spark, '{"v":null}', '{"w":1}', '{"v":{}}', "5"), F.col("t"), values={"x": "v"})
    assert [r[0] for r in df.select(F.col("x").isNotNull()).collect()] == [True, False, True, False]


def test_string_only(spark):
    df = J.with_json_fields(texts(spark, '{"v":"x"}', '{"v":1}', '{"v":null}', "{}"), F.col("t"), values={"x": "v"})
    assert [r[0] for r in df.select(J.string_or_null(F.col("x"))).collect()] == ["x", None, None, None]


def test_many_paths_at_once(spark):
    """Shared parents, a path below another, names that differ by case, repeated paths, odd members."""
    paths = {"p": "a.b", "q": "a.c.d", "r": "a.c", "s": "A.b", "t1": "x", "t2": "x", "u": "l.1.m", "w": "k.b"}
    text = '{"a":{"b":1,"c":{"d":2}},"A":{"b":3},"x":"4","l":[{},{"m":5}],"k":7,"pad":[1,2,3]}'
    df = J.with_json_fields(texts(spark, text), F.col("t"), paths, {"v": "a.b", "z": "a"})
    row = df.select("__ok", *[strict_double(F.col(c)).alias(c) for c in paths], F.to_json("z").alias("z")).first()
    assert row.asDict() == {
        "__ok": True, "p": 1.0, "q": 2.0, "r": None, "s": 3.0, "t1": 4.0, "t2": 4.0, "u": 5.0, "w": None,
        "z": '{"b":1,"c":{"d":2}}',
    }


def test_mistyped_members_leave_the_others(spark):
    df = J.with_json_fields(texts(spark, '{"a":5,"b":1}', '{"b":1,"a":[{"x":1}]}'), F.col("t"), {"x": "a.x", "y": "b"})
    assert [(r.x, r.y) for r in df.collect()] == [(None, "1"), (None, "1")]


def test_empty_path_part():
    with pytest.raises(ValueError):
        J.with_json_fields(None, None, {"x": "a..b"})


def test_strictness_against_python(spark):
    """Damaged documents: every way of reading must agree with a strict parser."""
    import json
    import random

    def strict(text):
        def refuse(word):
            raise ValueError(word)

        try:
            json.loads(text, parse_constant=refuse)
        except ValueError:
            return False
        return True

    rng = random.Random(11)
    base = '{"a":{"b":[1,{"c":"x\\n"},null],"d":-1.5e3},"l":[[1,2],[3]],"s":"q","t":true,"a2":{"x":{"y":0}}}'
    samples = {base}
    for _ in range(1500):
        text = list(base)
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(text))
            how = rng.random()
            if how < 0.4:
                del text[at]
            elif how < 0.7:
                text.insert(at, rng.choice('{}[],:"1x '))
            else:
                text = text[: at + 1]
        samples.add("".join(text))
    want = {t: strict(t) for t in samples}
    df = texts(spark, *samples)
    by_path = J.with_json_fields(df, F.col("t"), {"m": "a.d", "n": "l.0.1", "o": "a2.x.y", "p": "s"}, {"v": "t"}, ok="fields")
    both = by_path.withColumns({"whole": J.is_valid_json(F.col("t")), "doc": J.parse_document(F.col("t"))})
    rows = both.withColumn("variant", J.is_document("doc")).select("t", "fields", "whole", "variant").collect()
    odd = [r for r in rows if {r.fields, r.variant, r.whole} != {want[r.t]}]
    assert odd == []
    assert sum(want.values()) > 20


def test_big_documents(spark):
    """Beyond the limit of a VARIANT."""
    df = spark.sql("select concat('[', repeat('1,', 80000000), '1]') t union all select concat('[', repeat('1,', 80000000)) t")
    assert sorted(r[0] for r in df.select(J.is_valid_json(F.col("t"))).collect()) == [False, True]
