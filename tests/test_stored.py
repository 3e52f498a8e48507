"""What the jobs store and move between their steps, and that nothing is lost by it."""

from pyspark.sql import functions as F

from asksift.functions.responses import parse_labels
from asksift.llm.mixing import _entropies, _repeats
from asksift.operators.batching import render_prompts, with_listed_texts, without_listed_texts
from asksift.operators.labelling import align_labels, dead_letters, hash_echoes, parse_responses
from asksift.operators.triage import triage_with_responses, widen_triage


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_stored_once_with_their_prompts(spark):
    lists = [["a", "b - c"], ["x\n- y", "z"], [""], ["a\n", "- b"], [], [None, "a"]]
    rows = [("r", i, len(t), t) for i, t in enumerate(lists)]
    batches = spark.createDataFrame(rows, "run_name string, batch_id long, n_queries int, queries array<string>")
    stored = without_listed_texts(render_prompts(batches, "Say:\n"), "Say:\n")
    kept = {r.batch_id for r in stored.where(F.col("queries").isNotNull()).collect()}
    assert kept == {1, 4, 5}
    back = with_listed_texts(stored)
    assert back.columns == [*batches.columns, "prompt"]
    assert [r.queries for r in back.orderBy("batch_id").collect()] == lists


def test_labels_from_hashed_echoes(spark):
    batches = spark.createDataFrame([("r", 0, [1, 2], ["a", "b"])], "run_name string, batch_id long, ids array<long>, queries array<string>")
    raws = [("r", 0, '[{"query":"a","explicit_question":"yes"},{"query":"c"}]'), ("r", 1, "none")]
    parsed = parse_responses(spark.createDataFrame(raws, "run_name string, batch_id long, raw string"))
    stored = hash_echoes(parsed)
    assert "items" not in stored.columns
    for one, other in ((dead_letters(parsed), dead_letters(stored)), (align_labels(batches, parsed), align_labels(batches, stored))):
        assert sorted(one.collect()) == sorted(other.collect()) != []


def test_answers_in_the_form_asked_for_and_others(spark):
    said = {
        '[{"query":" a ]","explicit_question":" yes"},{}]': [("a ]", "YES"), ("", "NO")],
        '```[ {"query": "a b",\n "explicit_question": "no"} , null ]```': [("a b", "NO"), (None, None)],
        '[{"query":1,"explicit_question":null}]': [(None, None)],
        '[{"explicit_question":"no","query":"\\u00e9"}]': [("é", "NO")],
        '[{"query":"a","query":"a"}]': None,
        '[{"query":"a"}] []': None,
        "[1]], [2]": None,
        "[nu ll]": None,
    }
    raws = spark.createDataFrame(list(enumerate(said)), "i int, raw string")
    found = raws.select("i", parse_labels(F.col("raw")).alias("x")).orderBy("i").collect()
    assert [None if r.x is None else [tuple(item) for item in r.x] for r in found] == list(said.values())


def _triaged(spark):
    texts = spark.createDataFrame([(1, "t"), (2, "u"), (None, "v")], "UniqueID long, Query string")
    raws = [
        (1, "m", "Category: Background\nReasoning: b"), (1, "m", "Category: Foreground\nReasoning: a"),
        (1, "m", "Category: Foreground\nReasoning: c"), (1, "n", None), (2, "other", "Category: Foreground"),
    ]
    again = [(1, "m", '"q"'), (1, "m", '"p"'), (1, "n", "not asked"), (2, "m", "x")]
    schema = "UniqueID long, model string, raw string"
    return triage_with_responses(texts, ["m", "n"], spark.createDataFrame(raws, schema), spark.createDataFrame(again, schema))


def test_last_triage_answer_counts(spark):
    rows = {(r.UniqueID, r.model): tuple(r)[3:] for r in _triaged(spark).collect()}
    assert rows.pop((1, "m")) == ("Foreground", "c", "q")
    assert set(rows) == {(1, "n"), (2, "m"), (2, "n"), (None, "m"), (None, "n")}
    assert set(rows.values()) == {("", "", "")}
    wide = {r.UniqueID: tuple(r)[2:] for r in widen_triage(_triaged(spark), ["m", "n"]).collect()}
    assert wide[1] == ("Foreground", "c", "q", "N/A", "N/A", "N/A")


def test_triage_moves_no_reason_that_is_not_read(spark):
    plan = _plan(_triaged(spark).groupBy("model", "category").count())
    assert "Reasoning:" not in plan and "again" not in plan
    assert "Reasoning:" in _plan(_triaged(spark))


def test_exponents_are_rows(spark, monkeypatch):
    shares = spark.createDataFrame([("a", 3, 4, 0.75), ("b", 1, 4, 0.25)], "source string, tokens long, total long, share double")
    seen = []
    collect = type(shares).collect
    monkeypatch.setattr(type(shares), "collect", lambda df: (seen.append(len(df.columns)), collect(df))[1])
    many = [k / 32 for k in range(1, 32)]
    assert abs(_entropies(shares, many)[15] - 0.6568) < 1e-3
    assert abs(_repeats(shares, many, 1.0)[-1] - (0.25 ** (31 / 32 - 1)) / (0.75 ** (31 / 32) + 0.25 ** (31 / 32))) < 1e-9
    assert seen == [4, 4]
