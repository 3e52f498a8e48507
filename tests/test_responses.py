import json
import random
import re

import pytest
from pyspark.sql import functions as F

from asksift.functions import responses as p

GOOD = '[{"query": " a ", "explicit_question": " yes "}, {"query": "b"}]'


def items(spark, raw):
    row = spark.createDataFrame([(raw,)], "raw string").select(p.parse_labels(F.col("raw")).alias("x")).first()
    return None if row.x is None else [(i.query, i.explicit_question) for i in row.x]


@pytest.mark.parametrize(
    "raw",
    [
        GOOD,
        f"  {GOOD}\n",
        f"```json\n{GOOD}\n```",
        f"```\n{GOOD}```",
        f"Here it is:\n{GOOD}\nAnything else?",
    ],
)
def test_readable(spark, raw):
    assert items(spark, raw) == [("a", "YES"), ("b", "NO")]


@pytest.mark.parametrize(
    "raw",
    [None, "", "no array", "[1],[2]", f"{GOOD},{GOOD}", f"{GOOD}, []", '[{"query": "a", "query": "b"}]', "[NaN]", "['a']", "[01]", '["a\tb"]', GOOD[:-1], f"{GOOD} see [1]", f"{GOOD}{GOOD}", "[1,]", "[" * 100_000 + "]"],
)
def test_unreadable(spark, raw):
    assert items(spark, raw) is None


def test_labels_are_read_in_the_jvm(spark):
    df = spark.createDataFrame([(GOOD,)], "raw string").select(p.parse_labels(F.col("raw")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_generated_texts_are_read_as_strictly_as_by_a_plain_parser(spark):
    rng = random.Random(5)
    parts = ['{"query": "a"}', '{"query":" \u00a0b ","explicit_question":"no"}', "1", "null", "[]", '"x"', "{}", ",", "]", "[", " ", "\n", "true", '{"explicit_question": 3}', '{"query": {"a": [1]}}', "-", "1e5", '"\\u00e9"']
    raws = ["".join(rng.choice(parts) + rng.choice(["", "", ","]) for _ in range(rng.randrange(6))) for _ in range(3000)]
    raws = [rng.choice(["", "[", "x ["]) + r + rng.choice(["", "]", "] y"]) for r in raws]

    def plain(raw):
        found = re.search(r"(?s)\[.*\]", raw)
        try:
            values = json.loads(found.group()) if found else None
        except ValueError:
            return None
        if values is None:
            return None
        out = []
        for v in values:
            if not isinstance(v, dict):
                out.append((None, None))
                continue
            q, e = v.get("query", ""), v.get("explicit_question", "NO")
            out.append((q.strip() if isinstance(q, str) else None, e.strip().upper() if isinstance(e, str) else None))
        return out

    rows = spark.createDataFrame(list(enumerate(raws)), "i int, raw string").select("i", p.parse_labels(F.col("raw")).alias("x")).collect()
    got = {r.i: None if r.x is None else [tuple(i) for i in r.x] for r in rows}
    expected = {i: plain(raw) for i, raw in enumerate(raws)}
    assert sum(x is not None for x in expected.values()) > 200
    assert {i: (raws[i], got[i], expected[i]) for i in got if got[i] != expected[i]} == {}


def test_odd_items_keep_their_place(spark):
    raw = '[1, null, {"explicit_question": null}, {"query": 5, "explicit_question": true}, {}]'
    assert items(spark, raw) == [
        (None, None), (None, None), ("", None), (None, None), ("", "NO"),
    ]
    assert items(spark, "[]") == []


@pytest.mark.parametrize(
    "raw, category, reasoning",
    [
        ("Category: Foreground\nReasoning: a\nb ", "Foreground", "a\nb"),
        ('"category:  [BACKGROUND] maybe\r\nREASONING:x"', "Background", "x"),
        ("Category:\n\n unrelated\nmore", "Unrelated", ""),
        ("Category: Other \nReasoning:", "Other", ""),
        ("Category: background or foreground", "Foreground", ""),
        ("Reasoning: Category: x", "x", "Category: x"),
        ("Category: a\u2028b\nReasoning: c", "a\u2028b", "c"),
        ("nothing", "", ""),
        ("", "", ""),
        (None, "", ""),
    ],
)
def test_triage_answer(spark, raw, category, reasoning):
    row = (
        spark.createDataFrame([(raw,)], "raw string")
        .select(p.triage_category(F.col("raw")).alias("c"), p.triage_reasoning(F.col("raw")).alias("r"))
        .first()
    )
    assert (row.c, row.r) == (category, reasoning)


@pytest.mark.parametrize(
    "raw, question, vague",
    [
        (" \"'Should A vs B?'\"\n", "Should A vs B?", False),
        ("'\"x\"'", '"x"', False),
        ('"Error: Intervention too vague."', "Error: Intervention too vague.", True),
        (None, "", False),
    ],
)
def test_structured_question(spark, raw, question, vague):
    q = p.structured_question(F.col("raw"))
    row = spark.createDataFrame([(raw,)], "raw string").select(q.alias("q"), p.is_too_vague(q).alias("v")).first()
    assert (row.q, row.v) == (question, vague)
