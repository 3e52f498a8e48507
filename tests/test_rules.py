import random

import pytest
from pyspark.sql import functions as F

from asksift.functions import rules as r


def is_word(c):
    return c.isalnum() or c == "_"


def whole_word(s, word, start=0):
    at = s.find(word, start)
    while at >= 0:
        end = at + len(word)
        before = at == 0 or not is_word(s[at - 1])
        if before and (end == len(s) or not is_word(s[end])):
            return True
        at = s.find(word, at + 1)
    return False


def opens_with(s, word):
    return s.startswith(word) and (len(s) == len(word) or not is_word(s[len(word)]))


def brute(text):
    """The rules by plain string search."""
    if not text:
        return None
    s = text.strip().lower()
    if s.endswith("?"):
        return "punctuation"
    clause = s
    for stop in ".!?":
        clause = clause.split(stop)[0]
    if any(opens_with(s, w) for w in r.INVERTED_MODALS + r.INVERTED_BE):
        return "structure"
    for marker in r.CLAUSE_MARKERS:
        # a full stop right after the marker still ends it as a word
        if whole_word(s[: len(clause) + 1], marker):
            return "structure"
    if any(whole_word(s, w) for words in r.KEYWORDS.values() for w in words):
        return "keyword"
    for phrase in r.REQUEST_PHRASES:
        at = s.find(phrase)
        while at >= 0:
            end = at + len(phrase)
            if end == len(s) or not is_word(s[end]):
                return "request"
            at = s.find(phrase, at + 1)
    return None


def random_texts(n):
    rng = random.Random(7)
    pieces = [w for words in r.KEYWORDS.values() for w in words]
    pieces += r.INVERTED_BE + r.CLAUSE_MARKERS + r.REQUEST_PHRASES
    glue = [" ", "", "-", "_", ". ", "?", "? ", "!", ",", "x", "é", "9", "\u0301", "\u200c",
            "\n", "\u2028", "\xa0", "'", "ب", "ж", "İ", "²", "漢", "'s"]
    fill = ["cat", "Haus", "niño", "кот", "کتاب", "WHAT", "Is", "Could You", "x", ""]
    return [
        "".join(rng.choice(rng.choice([pieces, glue, fill, glue])) for _ in range(rng.randrange(1, 7)))
        for _ in range(n)
    ]


def test_rules_against_plain_search(spark):
    texts = [None, "", " ", *random_texts(6000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, Query string")
    rows = (
        r.label_by_rules(df)
        .select("i", "Rules", r.fired_rule(F.col("Query")).alias("rule"))
        .collect()
    )
    wrong = [(texts[x.i], x.rule, brute(texts[x.i])) for x in rows if x.rule != brute(texts[x.i])]
    assert not wrong
    assert all(x.Rules == ("YES" if x.rule else "NO") for x in rows)
    assert {x.rule for x in rows} == {None, *r.RULES}


@pytest.mark.parametrize(
    "text, label",
    [
        ("pollen map", "NO"),
        ("pollen map ?  ", "YES"),
        ("What causes it", "YES"),
        ("whatever", "NO"),
        ("est-ce que c'est grave", "YES"),
        ("por qué estornudo", "YES"),
        ("porqué", "NO"),
        ("geliyor mu", "YES"),
        ("was", "YES"),
        ("xcould you help", "YES"),
        ("xcould youth", "NO"),
        ("i wonder if", "YES"),
        ("они могли бы", "YES"),
        ("هل تعلم", "YES"),
        ("am tired", "YES"),
        ("so am i", "NO"),
    ],
)
def test_single_texts(spark, text, label):
    df = spark.createDataFrame([(text,)], "Query string")
    assert r.label_by_rules(df).first().Rules == label


def test_keyword_lists():
    assert {k: len(v) for k, v in r.KEYWORDS.items()} == {
        "en": 17, "fr": 10, "es": 9, "de": 9, "nl": 9, "ru": 9, "ar": 8, "fa": 7, "tr": 11,
    }
    words = [w for ws in r.KEYWORDS.values() for w in ws]
    assert len(words) == 89 and len(set(words)) == 88
