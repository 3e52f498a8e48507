import random
import re
import unicodedata

from pyspark.sql import functions as F

from asksift.functions import text as t


def expected(value):
    if value is None:
        return ""
    folded = unicodedata.normalize("NFKC", value).replace("\u200b", "")
    return " ".join(re.findall(r"\S+", folded))


def random_texts(n, seed):
    rng = random.Random(seed)
    blanks = [c for c in map(chr, range(0x3001)) if c.isspace()]
    odd = list("ﬁ½①ｶﾞＡé\u0301\u0308\u200b\u200c\u200d²ſİßǅ") + ["e\u0301", "ㄱ"]
    plain = list("abc XYZ,.?-'éüçñ") + ["что", "هل", "چه"]
    return [
        "".join(rng.choice(rng.choice([blanks, odd, plain, plain])) for _ in range(rng.randrange(12)))
        for _ in range(n)
    ]


def test_blank_characters_are_all_and_only_the_unicode_ones():
    assert sorted(t.BLANK_CHARS) == [c for c in map(chr, range(0x110000)) if c.isspace()]


def test_normalize_text(spark):
    texts = [None, "", " ", "\u200b", "a\xa0\u3000b\x1cc\x85", *random_texts(3000, 1)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    rows = df.select("i", t.normalize_text(F.col("x")).alias("y")).collect()
    assert {r.i: r.y for r in rows} == {i: expected(x) for i, x in enumerate(texts)}


def test_numbers_become_text(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "x double")
    rows = df.select(t.normalize_text(F.col("x")).alias("y")).collect()
    assert [r.y for r in rows] == ["1.5", ""]


def test_strip_and_case(spark):
    texts = random_texts(1000, 2)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    rows = df.select(
        "i",
        t.strip_lower(F.col("x")).alias("low"),
        t.strip_upper(F.col("x")).alias("up"),
        t.strip_quotes(F.concat(F.lit(" \"'"), F.col("x"), F.lit("'\"\"\n"))).alias("bare"),
    ).collect()
    for r in rows:
        x = texts[r.i]
        assert r.low == x.strip().lower()
        assert r.up == x.strip().upper()
        assert r.bare == f"'{x}'".strip("'")
