import hashlib

import pytest
from pyspark.sql import functions as F

from asksift.operators import batching as b


@pytest.fixture(scope="module")
def texts(spark):
    return spark.range(1, 324).select(
        F.col("id").alias("UniqueID"), F.concat(F.lit("text "), F.col("id")).alias("Query")
    )


RUNS = b.two_runs(["m", "n"], "seed")


def test_two_runs_per_rater():
    assert [r.name for r in RUNS] == ["LLM_run1_m", "LLM_run2_m", "LLM_run1_n", "LLM_run2_n"]
    assert [r.seed for r in RUNS] == [None, "seed:m", None, "seed:n"]


def test_every_text_is_in_one_batch_of_every_run(texts):
    rows = b.assign_batches(texts, RUNS).collect()
    for run in RUNS:
        mine = sorted((r for r in rows if r.run_name == run.name), key=lambda r: (r.batch_id, r.pos))
        assert sorted(r.UniqueID for r in mine) == list(range(1, 324))
        assert [(r.batch_id, r.pos) for r in mine] == [divmod(i, 50) for i in range(323)]
        order = list(range(1, 324))
        if run.seed:
            order.sort(key=lambda i: (hashlib.md5(f"{run.seed}:{i}".encode()).hexdigest(), i))
        assert [r.UniqueID for r in mine] == order


def test_runs_mix_texts_differently_and_repeat(texts):
    def batches(df):
        found = {}
        for r in df.collect():
            found.setdefault((r.run_name, r.batch_id), []).append(r.UniqueID)
        return found

    once = batches(b.assign_batches(texts, RUNS))
    again = batches(b.assign_batches(texts.repartition(7), RUNS))
    assert {k: sorted(v) for k, v in once.items()} == {k: sorted(v) for k, v in again.items()}
    assert sorted(once["LLM_run1_m", 0]) != sorted(once["LLM_run2_m", 0])
    assert sorted(once["LLM_run2_m", 0]) != sorted(once["LLM_run2_n", 0])


def test_batches_and_prompts(texts):
    batches = b.collect_batches(b.assign_batches(texts, RUNS[:1], size=100))
    rows = {r.batch_id: r for r in b.render_prompts(batches, "P:\n").collect()}
    assert [rows[i].n_queries for i in range(4)] == [100, 100, 100, 23]
    assert rows[3].ids == list(range(301, 324))
    assert rows[3].prompt == "P:\n" + "".join(f"- text {i}\n" for i in range(301, 324))


def test_batches_straight_from_the_texts_are_the_same(texts):
    def rows(df):
        return sorted((r.run_name, r.batch_id, r.n_queries, r.ids, r.queries) for r in df.collect())

    assert rows(b.make_batches(texts, RUNS)) == rows(b.collect_batches(b.assign_batches(texts, RUNS)))
    assert len(rows(b.make_batches(texts, RUNS[:1]))) == len(rows(b.make_batches(texts, RUNS[1:2]))) == 7


def test_batch_sizes(texts):
    sizes = b.batch_sizes(b.assign_batches(texts, RUNS)).collect()
    assert sorted(r.n_queries for r in sizes) == [23] * 4 + [50] * 24


def test_default_preamble_names_the_answer_format():
    assert '"query"' in b.DEFAULT_PREAMBLE and '"explicit_question"' in b.DEFAULT_PREAMBLE


@pytest.mark.parametrize("size", [1, 7, 50, 400])
def test_batches_over_bucket_ends(spark, monkeypatch, size):
    monkeypatch.setattr(b, "BUCKET_TEXTS", 20)

    def rows(df):
        return sorted((r.run_name, r.batch_id, r.n_queries, r.ids, r.queries) for r in df.collect())

    ids = [(i, f"t{i}") for i in range(1, 331)]
    texts = spark.createDataFrame(ids[::2] + ids[1::2], "UniqueID long, Query string").repartition(3)
    assert rows(b.make_batches(texts, RUNS, size)) == rows(b.collect_batches(b.assign_batches(texts, RUNS, size)))


def test_repeated_and_missing_ids_are_batched_as_assigned(spark):
    ids = [(1, "a"), (1, "b"), (3, "c"), (None, "d"), (4, None)]
    texts = spark.createDataFrame(ids, "UniqueID long, Query string")
    assert b._count_ids(texts) == (5, False)
    got = {r.batch_id: (r.n_queries, r.queries) for r in b.make_batches(texts, RUNS[:1], 2).collect()}
    assert got == {0: (2, ["a", "b"]), 1: (2, ["c", None]), None: (1, ["d"])}


def test_seeded_texts_are_moved_once_per_run(spark, texts, folder):
    texts.write.parquet(f"{folder}/t")
    made = b.make_batches(spark.read.parquet(f"{folder}/t"), RUNS[1:2])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "UniqueID" in plan and "Join Inner, (UniqueID" not in plan


def test_members_can_be_collected_without_texts(texts):
    batches = b.collect_batches(b.assign_batches(texts, RUNS).drop("Query"))
    assert batches.columns == ["run_name", "batch_id", "n_queries", "ids"] and batches.count() == 28


def test_no_bucket_of_texts_is_sorted_to_join_its_count(spark):
    """Whatever Spark takes the counts for: a row per bucket is broadcast."""
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(1, 200)], "UniqueID long, Query string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = b.make_batches(texts, [b.Run("LLM_run2_a", "s")], 50)
        plan = made._jdf.queryExecution().executedPlan().toString()
        rows = made.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan
    assert sorted(i for r in rows for i in r.ids) == list(range(1, 200))
