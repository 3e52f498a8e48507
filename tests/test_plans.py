import json

import pytest
from pyspark.sql import functions as F

from asksift.operators.batching import two_runs
from asksift.operators.identity import keep_first
from asksift.plans.agreement_study import agreement_study
from asksift.plans.question_detection import detect_questions, label_log, rule_rate, write_requests
from asksift.plans.triage_questions import triage_labelled_log, triage_questions
from asksift.sources.readers import prepare_log
from asksift.sources.stages import read_table, write_table
from tests import study_tables as study

RUNS = two_runs(["m", "n"], "seed")
PREAMBLE = "P\n"


def log_of(spark):
    texts = ["what is it", "pollen  map", "spray safe ?", " pollen map", None, "", "tree"]
    rows = [(i, texts[i % 7], f"u{i}") for i in range(140)]
    return prepare_log(spark.createDataFrame(rows, "ordinal long, Query string, user string"))


def labeller(prompt):
    texts = prompt.removeprefix(PREAMBLE).removeprefix("- ").removesuffix("\n").split("\n- ")
    return json.dumps([{"query": t, "explicit_question": "yes" if t == "tree" else "no"} for t in texts])


def broken(prompt):
    return "sorry"


CALLS = {"LLM_run1_m": labeller, "LLM_run2_m": labeller, "LLM_run1_n": broken}


def test_detection_job(spark, folder):
    log = log_of(spark)
    done = detect_questions(log, folder, RUNS, CALLS, size=2, preamble=PREAMBLE)
    assert done.log.columns == ["ordinal", "Query", "user", "UniqueID", "Rules", *[r.name for r in RUNS]]
    rows = done.log.collect()
    assert sorted(r.ordinal for r in rows) == sorted(r.ordinal for r in log.collect())
    assert {(r.Query, r.UniqueID, r.Rules, r.LLM_run1_m, r.LLM_run2_m, r.LLM_run1_n, r.LLM_run2_n) for r in rows} == {
        ("what is it", 1, "YES", "NO", "NO", None, None),
        ("pollen map", 2, "NO", "NO", "NO", None, None),
        ("spray safe ?", 3, "YES", "NO", "NO", None, None),
        ("", 4, "NO", "NO", "NO", None, None),
        ("tree", 5, "NO", "YES", "YES", None, None),
    }
    dead = read_table(spark, f"{folder}/dead_letters").collect()
    assert [(r.run_name, r.raw) for r in dead] == [("LLM_run1_n", "sorry")] * 3
    rates = {r.Rules: (r.n_rows, r.n_texts) for r in rule_rate(done.log.drop("Rules").withColumn("g", F.lit(1)), "g").collect()}
    assert sum(n for n, _ in rates.values()) == done.log.count()
    assert sum(t for _, t in rates.values()) == done.distinct.count()
    assert "ArrowEvalPython" not in done.log._jdf.queryExecution().executedPlan().toString()


def test_stored_responses_give_the_same(spark, folder):
    log = log_of(spark)
    requests = write_requests(log, f"{folder}/a", RUNS, 2, PREAMBLE)
    answers = [
        (r.run_name, r.batch_id, CALLS[r.run_name](r.prompt)) for r in requests.collect() if r.run_name in CALLS
    ]
    responses = spark.createDataFrame(answers, "run_name string, batch_id long, raw string")
    stored = label_log(f"{folder}/a", RUNS, responses)
    called = detect_questions(log, f"{folder}/b", RUNS, CALLS, 2, PREAMBLE)
    assert sorted(map(tuple, stored.log.collect())) == sorted(map(tuple, called.log.collect()))


def triager(system, user):
    text = user.split("\n", 1)[1]
    return "Category: Foreground\nReasoning: r" if "Category:" in system else f"Should {text}?"


def test_triage_job(spark, folder):
    done = detect_questions(log_of(spark), folder, RUNS, CALLS, 2, PREAMBLE)
    triaged, everything = triage_questions(done.distinct, folder, {"x": triager})
    assert {r.Query for r in triaged.collect()} == {"what is it", "spray safe ?", "tree"}
    rows = {r.Query: r for r in everything.collect()}
    assert len(rows) == 5
    assert rows["tree"].GRADE_Question_x == "Should tree?"
    assert rows["pollen map"].ARIA_Category_x == rows["pollen map"].LLM_run2_n == "N/A"
    # one row per id of the labelled log is the distinct table again
    first = keep_first(done.log, ["UniqueID"], ["ordinal"])
    assert sorted(r.UniqueID for r in first.collect()) == sorted(r.UniqueID for r in done.distinct.collect())


@pytest.mark.parametrize("gone", [[], ["Rules"], ["ordinal"], ["Rules", "ordinal"]])
def test_triage_of_a_stored_log(spark, folder, gone):
    done = detect_questions(log_of(spark), f"{folder}/d", RUNS, CALLS, 2, PREAMBLE)
    write_table(done.log.drop(*gone), f"{folder}/log")
    triaged, everything = triage_labelled_log(spark, f"{folder}/log", f"{folder}/t", {"x": triager})
    direct, _ = triage_questions(done.distinct.drop(*gone), f"{folder}/u", {"x": triager})
    assert sorted(r.Query for r in triaged.collect()) == sorted(r.Query for r in direct.collect())
    assert everything.count() == 5 and ("Rules" in everything.columns) == ("Rules" not in gone)


def test_job_normalises_once(spark, folder):
    raw = spark.createDataFrame([(i, f"ｑ{i % 3}") for i in range(9)], "ordinal long, Query string")
    raw.write.parquet(f"{folder}/raw")
    seen = []
    log = prepare_log(spark.read.parquet(f"{folder}/raw"))
    requests = write_requests(log, f"{folder}/j", RUNS, 2, PREAMBLE)
    for name in ("distinct", "requests"):
        seen.append(spark.read.parquet(f"{folder}/j/{name}").count())
    assert seen[0] == 3 and requests.count() == seen[1]
    landed = spark.read.parquet(f"{folder}/j/log")
    assert {r.Query for r in landed.collect()} == {"q0", "q1", "q2"}


def test_agreement_job(spark, folder):
    raters = study.RUNS + study.MANUAL
    ratings = study.frame(spark, study.SAMPLE, raters)
    done = agreement_study(ratings, {"runs": study.RUNS, "manual": study.MANUAL}, folder)
    assert done.overall.count() == 2 and done.specific.count() == 4 and done.matrix.count() == 81
    assert done.kappa["manual"].first().n_pairs == 1
    assert read_table(spark, f"{folder}/patterns").agg(F.sum("n_cases")).first()[0] == 246
