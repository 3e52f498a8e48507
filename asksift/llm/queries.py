"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.stages import shared_folder, stage
from . import warc
from .decontamination import decontaminate
from .extraction import extract_text
from .fingerprints import fingerprint_edits
from .hard_negatives import mine_hard_negatives
from .jaccard_join import jaccard_join
from .licences import background_lines, fit_licences, scan_licences
from .mixing import mix_sources
from .packing import pack_examples
from .paragraphs import dedupe_paragraphs
from .quality import held_out, score_quality
from .substrings import dedupe_substrings
from .vector_codes import books_digest, encode_vectors

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents drawn by source at 95 % of the highest entropy."""
    return mix_sources(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and that of its edited text."""
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_text(pages).select("page_id", "url", "text")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group and links at a similarity of 0.8 or more."""
    return jaccard_join(table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence paragraph of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit_licences(background_lines(docs))
    return scan_licences(docs, model).withColumnRenamed("text", "line")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived with a dictionary, and read back."""
    pages = table(spark, sf_dir, "pages")
    folder = shared_folder(spark)
    marked = warc.mark_revisits(pages)
    files = warc.write_archives(marked, f"{folder}/archives", warc.build_dictionary(pages))
    files = stage(files, f"{folder}/files")
    return warc.read_archives(warc.spread_files(spark, files), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the labels not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes without repeated strings of 100 bytes."""
    found = dedupe_substrings(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated paragraphs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dedupe_paragraphs(docs)
    return found.select(
        "doc_id",
        F.size("removed_lines").cast("long").alias("n_removed"),
        "removed_lines",
        "removed_words",
        "text",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share 13-word windows with benchmark items."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


#: Where the public tokenizers' files are, if not where their package says.
TOKENIZERS: str | None = None


def tokenizer_file(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens."""
    docs = table(spark, sf_dir, "documents")
    return pack_examples(docs, tokenizer_file("byte_bpe_50k.json"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; a seventh of the labels is moved."""
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine_hard_negatives(vectors, vec_id % 100 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code of four bytes and its error."""
    coded, books = encode_vectors(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op3_extraction": op3_extraction,
    "op7_quality": op7_quality,
    "op2_fingerprints": op2_fingerprints,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_licences": op5_licences,
    "op6_warc": op6_warc,
    "op8_substrings": op8_substrings,
    "op9_paragraphs": op9_paragraphs,
    "op10_decontamination": op10_decontamination,
    "op11_packing": op11_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_vector_codes": op13_vector_codes,
}
