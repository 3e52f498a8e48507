"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from asksift.functions.rules import label_by_rules
from asksift.operators import agreement, batching, labelling, merging, triage
from asksift.operators.identity import assign_ids, distinct_texts
from asksift.plans.question_detection import rule_rate
from asksift.sources.readers import prepare_log


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single|RoundRobin)", plan_of(df)))


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    spark.range(1000).select(
        F.col("id").alias("ordinal"),
        F.concat(F.lit("text "), F.col("id") % 50).alias("Query"),
        F.lit("x").alias("wide_column"),
    ).write.parquet(path + "/log")
    return spark.read.parquet(path + "/log")


@pytest.fixture(scope="module")
def distinct(spark, log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("distinct")) + "/d"
    assign_ids(distinct_texts(log)).write.parquet(path)
    return spark.read.parquet(path)


def test_dedupe_reads_two_columns_and_shuffles_once(log):
    found = distinct_texts(prepare_log(log))
    assert shuffles(found) == 1
    (schema,) = re.findall(r"ReadSchema: (\S+)", plan_of(found))
    assert schema == "struct<ordinal:bigint,Query:string>"


def test_rules_stay_in_the_jvm(distinct):
    plan = plan_of(label_by_rules(distinct))
    assert "Python" not in plan and "ArrowEval" not in plan and shuffles(label_by_rules(distinct)) == 0


def test_plain_runs_are_cut_without_a_sort(distinct):
    cut = batching.assign_batches(distinct, [batching.Run("LLM_run1_a"), batching.Run("LLM_run1_b")])
    assert shuffles(cut) == 0 and "Sort" not in plan_of(cut)


def test_labels_widen_in_one_shuffle(spark):
    labels = spark.createDataFrame([(1, "a", "YES")], "UniqueID long, run_name string, label string")
    wide = merging.widen_labels(labels, ["a", "b"])
    assert shuffles(wide) == 1 and "partial_max" in plan_of(wide)
    triaged = spark.createDataFrame(
        [(1, "q", "m", "F", "r", "")],
        "UniqueID long, Query string, model string, category string, reasoning string, question string",
    )
    assert shuffles(triage.widen_triage(triaged, ["m"])) == 1
    assert "SortAggregate" not in plan_of(triage.widen_triage(triaged, ["m"]))


def test_triage_answers_meet_by_id_alone(spark):
    texts = spark.createDataFrame([(1, "q")], "UniqueID long, Query string")
    answers = spark.createDataFrame([(1, "m", "x")], "UniqueID long, model string, raw string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = triage.triage_with_responses(texts, ["m", "n"], answers, answers)
        wide = triage.widen_triage(done, ["m", "n"])
        assert shuffles(done) == 2 and "SortAggregate" not in plan_of(wide) and shuffles(wide) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rule_rate_reads_the_log_once(log):
    rate = rule_rate(prepare_log(log.withColumn("lang", F.lit("x"))), "lang")
    plan = plan_of(rate)
    assert shuffles(rate) <= 2 and "Join" not in plan
    assert plan.count("Scan parquet") == 1 and plan.count("ArrowEvalPython") == 1


def test_agreement_counts_patterns_before_the_shuffle(log):
    ratings = log.select((F.col("ordinal") % 2).alias("a"), (F.col("ordinal") % 3 % 2).alias("b"))
    patterns = agreement.rating_patterns(ratings, ["a", "b"])
    assert shuffles(patterns) == 1 and "partial_count" in plan_of(patterns)
    (schema,) = re.findall(r"ReadSchema: (\S+)", plan_of(patterns))
    assert schema == "struct<ordinal:bigint>"


def test_no_cross_joins(log, distinct):
    runs = batching.two_runs(["a"], "s")
    batches = batching.collect_batches(batching.assign_batches(distinct, runs))
    responses = batches.select("run_name", "batch_id", F.lit("[]").alias("raw"))
    plans = [
        batching.run_matrix(distinct, runs),
        triage.model_matrix(distinct, ["m", "n"]),
        batches,
        labelling.align_labels(batches, labelling.parse_responses(responses)),
        merging.merge_back(log, label_by_rules(distinct)),
    ]
    for df in plans:
        assert "Cartesian" not in plan_of(df) and "NestedLoop" not in plan_of(df)


def test_merge_back_broadcasts_only_the_hot_list(spark, log, distinct):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(merging.merge_back(log, label_by_rules(distinct)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
    assert "GreaterThan(n_rows,1000000)" in plan


def test_calls_can_be_spread(spark, distinct):
    runs = [batching.Run("r")]
    prompts = batching.render_prompts(batching.collect_batches(batching.assign_batches(distinct, runs, 5)))
    asked = labelling.request_responses(prompts, {"r": str}, tasks=6)
    assert asked.rdd.getNumPartitions() == 6 and asked.count() == 10


def test_stored_buckets_are_not_shuffled(spark, folder):
    from asksift.operators.identity import keep_first
    from asksift.sources.stages import bucketed_stage, open_bucketed

    rows = [(i % 20, i, f"q{i % 20}") for i in range(100)]
    log = bucketed_stage(spark.createDataFrame(rows, "UniqueID long, ordinal long, Query string"), f"{folder}/log", "UniqueID", 4, "ordinal")
    labels = spark.createDataFrame([(i, r, "YES") for i in range(20) for r in "ab"], "UniqueID long, run_name string, label string")
    labels = bucketed_stage(labels, f"{folder}/labels", "UniqueID", 4, "run_name")
    triaged = spark.createDataFrame([(i, f"q{i}", "x") for i in range(0, 20, 3)], "UniqueID long, Query string, ARIA_Category_m string")
    triaged = bucketed_stage(triaged, f"{folder}/triaged", "UniqueID", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = keep_first(log, ["UniqueID"], ["ordinal"])
        attached = merging.attach_labels(first, labels, ["a", "b"])
        done = merging.attach_triage(attached, triaged)
        for df in (first, merging.widen_labels(labels, ["a", "b"]), attached, done):
            assert "Exchange" not in plan_of(df)
        assert sorted(r.ordinal for r in done.collect()) == list(range(20))
        again = open_bucketed(spark.newSession(), f"{folder}/log", "UniqueID", 4, "ordinal")
        assert "Exchange" not in plan_of(again.groupBy("UniqueID").count()) and again.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
