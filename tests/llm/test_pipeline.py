"""The stages of the pipeline, each against what it is made of."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as c
from tests.llm.test_jaccard_join import brute_force as join_by_force
from tests.llm.test_paragraphs import whole_by_force

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for number, (_, step) in enumerate(c.STAGES):
        step(spark, docs[-1], SF).write.parquet(f"{folder}/{number}")
        docs.append(spark.read.parquet(f"{folder}/{number}"))
    return docs


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])
    assert {"doc_id", "source", "epoch", "at"} <= set(stages[-1].columns)


def test_quality_rejects_bad_documents_only(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = ids(stages[0]) - ids(stages[1])
    assert gone and sum(labels.get(i) == 1 for i in gone) == 0
    bad = [i for i, y in labels.items() if y == 0]
    assert sum(i in gone for i in bad) > len(bad) / 2


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert ids(stages[2]) == {r[1] for r in join_by_force(rows)}


def test_repeated_paragraphs_go(stages):
    expected = whole_by_force([(r.doc_id, r.text) for r in stages[2].collect()])
    after = {r.doc_id: r for r in stages[3].collect()}
    before = {r.doc_id: r.text for r in stages[2].collect()}
    left = {k for k, (_, text) in expected.items() if text == before[k] or text.strip()}
    assert set(after) == left
    for k, r in after.items():
        assert r.text == expected[k][1] and r.n_chars == len(r.text)


def test_contaminated_documents_go(spark, stages):
    from asksift.llm.decontamination import decontaminate

    bad = decontaminate(stages[3], spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated")
    assert ids(stages[4]) == ids(stages[3]) - ids(bad)


def test_mixture_draws_what_is_left(stages):
    assert ids(stages[5]) <= ids(stages[4])
    tokens = stages[4].select(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    assert abs(stages[5].agg(F.sum("n_tokens")).first()[0] - tokens) < 0.2 * tokens


def odd_documents(spark):
    """Given documents without ids, with shared ones, and given twice, nulls in
    every column, and columns that are called like those of the stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clash = ["score", "predicted", "removed_lines", "removed_words", "__id", "__name", "class_id", "contaminated", "epoch"]
    more = docs.where("doc_id < 40").withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit(3)).cast("long"))
    empty = docs.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    blank = empty.withColumn("text", F.lit(""))
    whole = docs.where("doc_id >= 40").union(more).union(more).union(empty).union(blank)
    return whole.withColumns({c: F.lit("x") for c in clash})


def test_odd_rows_and_columns(spark, folder):
    docs = odd_documents(spark)
    docs.write.parquet(f"{folder}/0")
    now = spark.read.parquet(f"{folder}/0")
    kept = [now]
    for number, (_, step) in enumerate(c.STAGES):
        step(spark, kept[-1], SF).write.parquet(f"{folder}/{number + 1}")
        kept.append(spark.read.parquet(f"{folder}/{number + 1}"))
    assert all(k.columns == docs.columns and k.where("score = 'x'").count() == k.count() for k in kept[:-1])
    # The same texts under ids of their own come to the same.
    texts = [[r.text for r in k.collect()] for k in kept[:-1]]
    named = [(i, t) for i, t in enumerate(sorted(set(t for t in texts[1] if t is not None)))]
    groups = len({r[1] for r in join_by_force(named)})
    assert len(texts[2]) == groups
    plain = {t for t in texts[2] if t is not None}
    assert sum(t in plain for t in texts[3]) >= 0.5 * len(texts[3]) and len(texts[3]) <= len(texts[2])
    from asksift.llm.decontamination import decontaminate

    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    numbered = spark.createDataFrame(list(enumerate(texts[3])), "doc_id long, text string")
    bad = decontaminate(numbered, benchmark).where("contaminated").count()
    assert len(texts[4]) == len(texts[3]) - bad


def test_no_documents(spark, folder):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    assert c.run(spark, folder).count() == 0
