import random

import pytest
from pyspark.sql import functions as F

from asksift.operators import identity
from asksift.plans.distinct import dedupe


def log_of(spark, rows, parts=3):
    return spark.createDataFrame(rows, "ordinal long, Query string").repartition(parts)


@pytest.mark.parametrize("spread", [1, 1 << 12, 1 << 19, 1 << 33, 1 << 41])
def test_ids_follow_first_appearance(spark, spread):
    rng = random.Random(spread)
    rows = [(spread * (i + 1), f"q{rng.randrange(60)}") for i in range(400)]
    order = list(dict.fromkeys(q for _, q in rows))
    got = {r.Query: r for r in dedupe(log_of(spark, rows)).collect()}
    assert {q: r.UniqueID for q, r in got.items()} == {q: i + 1 for i, q in enumerate(order)}
    for q, r in got.items():
        places = [o for o, x in rows if x == q]
        assert (r.first_ordinal, r.n_rows) == (min(places), len(places))


def test_null_and_tied_ordinals(spark):
    rows = [(1, "a"), (None, "b"), (2, "d"), (2, "c"), (None, "e"), (1 << 62, "z")]
    for parts in (1, 4):
        got = {r.Query: r.UniqueID for r in dedupe(log_of(spark, rows, parts)).collect()}
        assert got == {"a": 1, "c": 2, "d": 3, "z": 4, "b": 5, "e": 6}


def test_empty_log(spark):
    assert dedupe(log_of(spark, [])).count() == 0


def test_partitioning_does_not_matter(spark):
    rows = [(i * 7919 % 100_003 << 15, f"q{i % 50}") for i in range(500)]
    results = []
    for parts, shuffles in ((1, 1), (8, 8)):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        results.append(sorted(map(tuple, dedupe(log_of(spark, rows, parts)).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1]


def test_hot_text_is_combined_before_the_shuffle(spark):
    log = spark.range(30_000).select(
        F.col("id").alias("ordinal"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("Query"),
    )
    found = identity.distinct_texts(log)
    assert found.where("Query = 'hot'").first().n_rows == 10_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_count" in plan


def test_keep_first(spark):
    rows = [(k, o, f"{k}-{o}") for k in range(5) for o in random.Random(k).sample(range(100), 20)]
    df = spark.createDataFrame(rows, "UniqueID long, ordinal long, x string")
    kept = identity.keep_first(df, ["UniqueID"], ["ordinal"])
    expected = {k: min(o for kk, o, _ in rows if kk == k) for k in range(5)}
    assert {r.UniqueID: r.ordinal for r in kept.collect()} == expected
    assert kept.columns == df.columns
    # one row per key and task is all that is shuffled
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_numbering_within_groups(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("k"), "id"
    )
    got = identity.number_rows(
        df, "n", order=[F.col("k")], levels=[F.substring("k", 1, 2), F.substring("k", 1, 1)], within=("g",)
    ).collect()
    for g in range(3):
        rows = sorted((r for r in got if r.g == g), key=lambda r: r.k)
        assert [r.n for r in rows] == list(range(1, len(rows) + 1))
