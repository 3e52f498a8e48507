"""Logs, raters and model answers that Spark derives from the given tables.

The query log is every sentence of every document. Models are stood in for by
deterministic answers (hashes of the text), so results can be checked in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.rules import is_question, label_by_rules
from ..operators.batching import make_batches, two_runs
from ..plans.distinct import dedupe
from ..sources.readers import prepare_log
from ..sources.stages import shared_folder, stage

RATERS = ["alpha", "beta", "gamma"]
SEED = "round"
RUNS = two_runs(RATERS, SEED)
RUN_NAMES = [run.name for run in RUNS]
MODELS = ["north", "south", "west"]
DOC_RATERS = ["rules", "quality", "toxic", "long_text", "has_digit"]
RATER_SETS = {
    "all": DOC_RATERS,
    "manual": ["quality", "toxic"],
    "derived": ["rules", "long_text", "has_digit"],
    "any": ["any_manual", "any_derived"],
}
DISPLAY = {"rules": "Rules", "quality": "Manual 1", "toxic": "Manual 2"}
LONG_TEXT = 1500
# A document has fewer sentences, a conversation fewer turns than that.
ROW_STEP = 1 << 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def hex_digit(*parts: Column) -> Column:
    """First hex digit of the md5 of the joined parts: a fair 16-sided die."""
    return F.substring(F.md5(F.concat_ws(":", *parts)), 1, 1)


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sentences of all documents; empty ones are null, as empty cells."""
    return (
        documents(spark, sf_dir)
        .select(
            "doc_id", "lang", F.posexplode(F.split("text", r"\.")).alias("pos", "Query")
        )
        .select(
            (F.col("doc_id") * ROW_STEP + F.col("pos")).alias("ordinal"),
            "doc_id",
            "lang",
            F.nullif("Query", F.lit("")).alias("Query"),
        )
    )


def sentence_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_log(raw_log(spark, sf_dir))


def question_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with question forms of several languages worked in, picked by
    the hash of the sentence."""
    q, digit = F.col("Query"), hex_digit(F.col("Query"))
    dressed = (
        F.when(digit == "0", F.concat(q, F.lit("?")))
        .when(digit == "1", F.concat(F.lit("Can "), q))
        .when(digit == "2", F.concat(F.lit("  Please EXPLAIN "), q))
        .when(digit == "3", F.concat(q, F.lit(" mu? ")))
        .when(digit == "4", F.concat(F.lit("x, est-ce que "), q))
        .when(digit == "5", F.concat(F.lit("هل "), q))
        .when(digit == "6", F.concat(F.lit("آیا "), q))
        .when(digit == "7", F.concat(F.lit("xcould you "), q))
        .otherwise(q)
    )
    return sentence_log(spark, sf_dir).withColumn("Query", dressed)


def distinct_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(sentence_log(spark, sf_dir))


def model_label(run_name: Column) -> Column:
    """A rater that follows the rules but errs on some texts, and leaves some
    out."""
    errs = hex_digit(run_name, F.col("Query")) < F.lit("3")
    says_yes = (F.col("Rules") == "YES") != errs
    present = hex_digit(F.lit("gap"), run_name, F.col("Query")) != "0"
    return F.when(present, F.when(says_yes, "YES").otherwise("NO"))


def model_labels(distinct: DataFrame) -> DataFrame:
    """Long labels of all runs for distinct texts."""
    names = F.array(*[F.lit(n) for n in RUN_NAMES])
    return (
        label_by_rules(distinct)
        .select("UniqueID", "Query", "Rules", F.explode(names).alias("run_name"))
        .select("UniqueID", "run_name", model_label(F.col("run_name")).alias("label"))
        .where(F.col("label").isNotNull())
    )


def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts with rule labels and one column per run, for what reads the
    labels once: they are not written before."""
    return label_by_rules(distinct_texts(spark, sf_dir)).withColumns(
        {name: model_label(F.lit(name)) for name in RUN_NAMES}
    )


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as the stage table that the detection job leaves."""
    return stage(labelled_rows(spark, sf_dir), f"{shared_folder(spark)}/distinct_labelled")


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make_batches(distinct_texts(spark, sf_dir), RUNS)


def model_responses(batched: DataFrame) -> DataFrame:
    """One raw response per batch, in the shapes that models produce: plain,
    fenced, chatty, cut off, followed by more brackets, a label too few, one
    too many, odd case, missing labels, nothing at all."""
    digit = hex_digit(F.lit("shape"), F.col("run_name"), F.col("batch_id"))

    def item(text: Column) -> Column:
        longer = F.length(text) > 40
        label = (
            F.when(F.col("shape") == "8", F.when(longer, " yes ").otherwise("no"))
            .when((F.col("shape") == "9") & longer, F.lit(None))
            .otherwise(F.when(longer, "YES").otherwise("NO"))
        )
        return F.struct(text.alias("query"), label.alias("explicit_question"))

    shaped = batched.withColumn("shape", digit).withColumn(
        "items", F.transform("queries", item)
    )
    extra = F.struct(
        F.lit("extra").alias("query"), F.lit("YES").alias("explicit_question")
    )
    text = F.to_json("items")
    raw = (
        F.when(F.col("shape") == "0", F.regexp_replace(text, r"\]\z", ""))
        .when(F.col("shape") == "1", F.concat(text, F.lit(" [end]")))
        .when(F.col("shape") == "2", F.concat(F.lit("```json\n"), text, F.lit("\n```")))
        .when(F.col("shape") == "3", F.concat(F.lit("Sure:\n"), text, F.lit("\nDone.")))
        .when(
            F.col("shape") == "4",
            F.to_json(F.slice("items", F.lit(1), F.col("n_queries") - 1)),
        )
        .when(F.col("shape") == "5", F.to_json(F.array_append("items", extra)))
        .when(F.col("shape") == "6", F.lit(None))
        .when(F.col("shape") == "7", F.lit(""))
        .otherwise(text)
    )
    return shaped.select("run_name", "batch_id", raw.alias("raw"))


def triage_answer(model: Column, text: Column) -> Column:
    """A raw triage response per model and text, well or badly formed."""
    digit = hex_digit(F.lit("triage"), model, text)
    return (
        F.when(digit < "4", F.concat(
            F.lit("Category: Foreground\nReasoning: names "), text, F.lit(" \nand more ")
        ))
        .when(digit < "7", F.concat(
            F.lit('"\'category:  [BACKGROUND]\nreasoning:'), text, F.lit("'\"")
        ))
        .when(digit < "a", F.lit("\n Category:\n unrelated topic \nReasoning: \n none "))
        .when(digit == "a", F.lit("Category: Other  \nReasoning: unsure"))
        .when(digit == "b", F.lit("I cannot tell."))
        .when(digit == "c", F.lit(""))
        .when(digit == "d", F.lit("Reasoning: Category: background and foreground"))
    )


def question_answer(model: Column, text: Column) -> Column:
    digit = hex_digit(F.lit("question"), model, text)
    return (
        F.when(digit < "4", F.lit(' "Error: Intervention too vague." '))
        .when(digit < "5", F.lit(""))
        .otherwise(F.concat(
            F.lit(" \"'Should "), F.trim(text), F.lit(" vs no treatment be used?'\"\n")
        ))
    )


def triage_responses(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored responses of both triage stages for all models."""
    models = F.array(*[F.lit(m) for m in MODELS])
    matrix = texts.select("UniqueID", "Query", F.explode(models).alias("model"))
    keys = ["UniqueID", "model"]
    return (
        matrix.select(*keys, triage_answer(F.col("model"), F.col("Query")).alias("raw")),
        matrix.select(*keys, question_answer(F.col("model"), F.col("Query")).alias("raw")),
    )


def document_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five 0/1 raters per document over its whole text; documents without a
    row in ``labels`` have null ratings there."""
    docs = documents(spark, sf_dir).select(
        "doc_id",
        is_question(F.col("text")).cast("int").alias("rules"),
        (F.col("n_chars") >= LONG_TEXT).cast("int").alias("long_text"),
        F.col("text").rlike("[0-9]").cast("int").alias("has_digit"),
    )
    return (
        docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .withColumn("any_manual", F.greatest("quality", "toxic"))
        .withColumn("any_derived", F.greatest("rules", "long_text", "has_digit"))
        .select("doc_id", *DOC_RATERS, "any_manual", "any_derived")
    )


MANY_RATERS = [f"rater{i:02d}" for i in range(40)]


def many_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty raters of every document, long: each follows the rules but for some
    documents, and leaves some out."""
    docs = documents(spark, sf_dir).select("doc_id", is_question(F.col("text")).cast("int").alias("rules"))
    rater = F.explode(F.array(*[F.lit(r) for r in MANY_RATERS])).alias("rater")
    digit = hex_digit(F.col("rater"), F.col("doc_id").cast("string"))
    errs = (digit < F.lit("3")).cast("int")
    return (
        docs.select("doc_id", "rules", rater)
        .where((digit != "f") | (F.col("doc_id") % 2 == 0))
        .select("doc_id", "rater", (F.col("rules").bitwiseXOR(errs)).alias("rating"))
    )
