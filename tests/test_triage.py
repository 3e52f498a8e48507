import pytest

from asksift.operators import triage as t


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(
        [(1, "spray safe"), (2, "what is it"), (3, "vague"), (4, "down")], "UniqueID long, Query string"
    )


def model(system, user):
    lead, text = user.split("\n", 1)
    if text == "down":
        raise ConnectionError("gone")
    if lead == t.CLASSIFY.lead:
        assert system == t.CLASSIFY.system
        return f"Category: {'background' if text == 'what is it' else 'foreground'}\nReasoning: on {text}"
    assert system == t.REFORMULATE.system and text != "what is it"
    return "Error: Intervention too vague." if text == "vague" else f' "Should {text}?" '


def silent(system, user):
    return ""


EXPECTED = {
    (1, "m"): ("Foreground", "on spray safe", "Should spray safe?"),
    (2, "m"): ("Background", "on what is it", ""),
    (3, "m"): ("Foreground", "on vague", "Error: Intervention too vague."),
    (4, "m"): ("", "", ""),
    **{(i, "quiet"): ("", "", "") for i in range(1, 5)},
}


def test_two_stages_with_calls(texts):
    rows = t.triage_with_calls(texts, {"m": model, "quiet": silent}).collect()
    assert {(r.UniqueID, r.model): (r.category, r.reasoning, r.question) for r in rows} == EXPECTED
    assert [(r.UniqueID, r.model) for r in rows if r.error] == [(4, "m")]


def test_two_stages_with_stored_responses(spark, texts):
    first = spark.createDataFrame(
        [(i, "m", model(t.CLASSIFY.system, f"{t.CLASSIFY.lead}\n{q}")) for i, q in
         [(1, "spray safe"), (2, "what is it"), (3, "vague")]],
        "UniqueID long, model string, raw string",
    )
    second = spark.createDataFrame(
        [(1, "m", '"Should spray safe?"'), (2, "m", "not asked for"), (3, "m", "Error: Intervention too vague.")],
        "UniqueID long, model string, raw string",
    )
    rows = t.triage_with_responses(texts, ["m", "quiet"], first, second).collect()
    assert {(r.UniqueID, r.model): (r.category, r.reasoning, r.question) for r in rows} == EXPECTED


def test_wide_triage(texts):
    triaged = t.triage_with_calls(texts, {"m": model})
    wide = t.widen_triage(triaged, ["m", "absent"])
    assert wide.columns == [
        "UniqueID", "Query", "ARIA_Category_m", "ARIA_Reasoning_m", "GRADE_Question_m",
        "ARIA_Category_absent", "ARIA_Reasoning_absent", "GRADE_Question_absent",
    ]
    rows = {r.UniqueID: tuple(r)[2:] for r in wide.collect()}
    gone = ("N/A",) * 3
    assert rows[1] == ("Foreground", "on spray safe", "Should spray safe?", *gone)
    assert rows[2] == ("Background", "on what is it", "N/A", *gone)
    assert rows[4] == (*gone, *gone)


def test_prompts(texts):
    row = t.render_triage_prompts(texts, t.Template("S", "L:")).where("UniqueID = 1").first()
    assert (row.system_prompt, row.user_prompt, row.single_prompt) == (
        "S", "L:\nspray safe", "S\n\nL:\nspray safe",
    )


def test_answers_of_all_models_move_once_per_text(spark, folder):
    """Rows of one text, also repeated ones, asked again, or without an id, give one row
    per model; both stages meet in one shuffle."""
    texts = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, "d")], "UniqueID long, Query string")
    failing = {"on": True}

    def model(system, user):
        lead, text = user.split("\n", 1)
        if text == "d" and failing["on"]:
            raise ValueError("down")
        return f"Category: Foreground\nReasoning: {text}" if lead == t.CLASSIFY.lead else f"Should {text}?"

    t.triage_with_calls(texts, {"m": model, "n": model}, folder=folder).collect()
    failing["on"] = False
    triaged = t.triage_with_calls(texts, {"m": model, "n": model}, folder=folder, rounds=2)
    rows = sorted((r.UniqueID or 0, r.Query, r.model, r.category, r.reasoning, r.question, r.error) for r in triaged.collect())
    found = [(u, q, m, "Foreground", q, f"Should {q}?" if u else "", None) for u, q in ((0, "c"), (1, "a"), (1, "b")) for m in "mn"]
    assert rows == [*found, *[(2, "d", m, "Foreground", "d", "Should d?", None) for m in "mn"]]
    plan = triaged.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
