"""A training corpus out of raw documents, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns documents again, the last
one the drawn mixture. Stages are written as Parquet and read again in between.

Null and empty texts pass the quality classifier only if it accepts the empty
text, are copies of each other, have no repeats, are not contaminated, and are
drawn as documents without tokens. Rows that share an id, or have none, are judged
each by its own text in all stages; rows with equal id and text are one document,
of which the second stage keeps one. Ties go to the smaller id, null first, then to
the smaller hash of the text. Further columns of the documents pass through the
first four stages, whatever their names. Empty documents give an empty mixture.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from asksift.llm.decontamination import decontaminate_documents
from asksift.llm.jaccard_join import keep_one_of_each_group
from asksift.llm.mixing import mix_sources
from asksift.llm.paragraphs import dedupe_paragraphs
from asksift.llm.quality import THRESHOLD, fit_quality, score_texts
from asksift.llm.words import unused
from asksift.sources.stages import shared_folder, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labels
    of this stage's own documents."""
    score = unused(docs.columns, "score")
    scored = score_texts(docs, fit_quality(docs, _table(spark, sf_dir, "labels")), into=score)
    return scored.where(F.col(score) >= THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return keep_one_of_each_group(docs)


def remove_repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without paragraphs and passages that stand earlier; a document of which
    nothing is left goes."""
    lines, words = unused(docs.columns, "removed_lines"), unused(docs.columns, "removed_words")
    cleaned = dedupe_paragraphs(docs, names=(lines, words))
    changed = (F.size(lines) > 0) | (F.col(words) > 0)
    emptied = changed & (F.trim("text") == "")
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", n_chars).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontaminate_documents(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn by source at the target entropy."""
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", reject_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", remove_repeated_paragraphs),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix),
]

#: The first stage is a trained model, which SQL cannot state.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    folder = shared_folder(spark)
    docs = _table(spark, sf_dir, "documents")
    for number, (_, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), f"{folder}/stage-{number}")
    return docs
