"""Labelling runs, batches of texts, and the prompts made from them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .identity import number_rows

# Texts per request, and the prefix of the columns that hold a
# model's labels.
BATCH_SIZE = 50
RUN_PREFIX = "LLM_run"

# A bucket of reshuffled ids has about so many before buckets get finer.
BUCKET_IDS = 4096

# The same for reshuffled texts. Batches that reach over the end of a bucket are
# sent once more, so buckets of texts are larger.
BUCKET_TEXTS = 32768

DEFAULT_PREAMBLE = (
    "The list below holds search queries in several languages. Say for each one "
    "whether it explicitly asks a question.\n\n"
    "Answer with a JSON array and nothing else, one element per query, in the "
    "order given:\n"
    '{ "query": "<query text>", "explicit_question": "YES" or "NO" }\n\n'
    "Queries:\n"
)


@dataclass(frozen=True)
class Run:
    """One labelling pass. Without a seed the texts go in id order."""

    name: str
    seed: str | None = None


def two_runs(raters: list[str], seed: str) -> list[Run]:
    """Per rater one pass in id order and one in a reshuffled order."""
    runs = []
    for rater in raters:
        runs.append(Run(f"{RUN_PREFIX}1_{rater}"))
        runs.append(Run(f"{RUN_PREFIX}2_{rater}", f"{seed}:{rater}"))
    return runs


def _split_runs(runs: list[Run]) -> tuple[list[Run], list[Run]]:
    plain = [run for run in runs if run.seed is None]
    return plain, [run for run in runs if run.seed is not None]


def run_matrix(df: DataFrame, runs: list[Run]) -> DataFrame:
    """Every row once per run: a map-side explode over the run list."""
    configs = F.array(
        *[
            F.struct(
                F.lit(run.name).alias("run_name"),
                F.lit(run.seed).cast("string").alias("seed"),
            )
            for run in runs
        ]
    )
    return df.select("*", F.inline(configs))


def shuffle_key(seed: Column, uid: Column) -> Column:
    """Repeatable random order: sorts like a reshuffle drawn with this seed."""
    return F.md5(F.concat_ws(":", seed, uid.cast("string")))


def _cut(ranked: DataFrame, rank: str, size: int) -> DataFrame:
    start = F.col(rank) - 1
    return ranked.withColumns(
        {
            "batch_id": F.floor(start / size).cast("long"),
            "pos": (start % size).cast("int"),
        }
    )


def _digits(ids: int, per_bucket: int) -> int:
    """Hex digits of a shuffle key that deal so many ids into buckets, 4 at most."""
    digits = 1
    while digits < 4 and ids >> (4 * digits) > per_bucket:
        digits += 1
    return digits


def _cut_seeded(texts: DataFrame, runs: list[Run], size: int) -> DataFrame:
    """Numbered by hash order, in even buckets of some thousand ids, at most 65,536
    per run. Only ids are numbered; the texts join once, after that."""
    digits = _digits(texts.count(), BUCKET_IDS)
    keyed = run_matrix(texts.select("UniqueID"), runs).withColumn(
        "__key", shuffle_key(F.col("seed"), F.col("UniqueID"))
    )
    ranked = number_rows(
        keyed,
        "__rank",
        order=[F.col("__key"), F.col("UniqueID")],
        levels=[F.substring("__key", 1, digits)],
        within=("run_name",),
    )
    return _cut(ranked, "__rank", size).join(texts, "UniqueID")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def assign_batches(
    distinct: DataFrame, runs: list[Run], size: int = BATCH_SIZE
) -> DataFrame:
    """Batch and position of every text in every run. Unseeded runs follow the
    dense id, so they need no sort at all."""
    texts = distinct.select("UniqueID", "Query")
    columns = ["run_name", "UniqueID", "Query", "batch_id", "pos"]
    plain, seeded = _split_runs(runs)
    parts = []
    if plain:
        parts.append(_cut(run_matrix(texts, plain), "UniqueID", size).select(columns))
    if seeded:
        parts.append(_cut_seeded(texts, seeded, size).select(columns))
    return _union(parts)


def _collect(assigned: DataFrame, *keys: str) -> DataFrame:
    """Ids and texts of a batch in order; bounded by the batch size, so no row
    grows with the data. Texts are left out where they are not given."""
    given = ["UniqueID", "Query"] if "Query" in assigned.columns else ["UniqueID"]
    members = F.array_sort(F.collect_list(F.struct("pos", *given)))
    gathered = assigned.groupBy(*keys).agg(members.alias("members"))
    names = {"UniqueID": "ids", "Query": "queries"}
    return gathered.select(
        *keys,
        F.size("members").alias("n_queries"),
        *[F.col(f"members.{c}").alias(names[c]) for c in given],
    )


def collect_batches(assigned: DataFrame) -> DataFrame:
    """One row per run and batch from the assigned texts, or ids alone."""
    return _collect(assigned, "run_name", "batch_id")


def _count_ids(texts: DataFrame) -> tuple[int, bool]:
    """Number of rows, and whether each has an id of its own from 1 on: 64 ids
    that follow each other set as many bits as they are."""
    start = F.col("UniqueID") - 1
    bit = F.expr("shiftleft(1L, cast(pmod(UniqueID - 1, 64) as int))")
    groups = texts.groupBy(F.floor(start / 64).alias("__group")).agg(
        F.count("*").alias("__n"), F.bit_count(F.bit_or(bit)).alias("__own"), F.min(start).alias("__least")
    )
    own = (F.col("__n") == F.col("__own")) & (F.col("__least") >= 0)
    n, each = groups.agg(F.sum("__n"), F.min(F.coalesce(own, F.lit(False)))).first()
    return n or 0, bool(each)


def _batches_in_order(texts: DataFrame, size: int) -> DataFrame:
    """Batches in id order, of texts with ids of their own. Where the texts lie by
    id, a task has most batches whole; only pieces are shuffled."""

    def neighbours(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks:
            if not chunk.num_rows:
                continue
            chunk = chunk.sort_by("UniqueID")
            ids, queries = chunk.column("UniqueID"), chunk.column("Query")
            batch = (ids.to_numpy() - 1) // size
            starts = np.flatnonzero(np.diff(batch, prepend=-1))
            ends = pa.array([*starts, len(batch)], pa.int32())
            yield pa.record_batch(
                [
                    pa.array(batch[starts], pa.int64()),
                    pa.ListArray.from_arrays(ends, ids),
                    pa.ListArray.from_arrays(ends, queries),
                ],
                ["batch_id", "ids", "queries"],
            )

    schema = "batch_id long, ids array<bigint>, queries array<string>"
    long = texts.select(F.col("UniqueID").cast("long").alias("UniqueID"), F.col("Query").cast("string").alias("Query"))
    pieces = long.mapInArrow(neighbours, schema)
    n_queries = F.size("ids").alias("n_queries")
    whole = pieces.where(F.size("ids") == size).select("batch_id", n_queries, "ids", "queries")
    members = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("ids", "queries"))))
    merged = pieces.where(F.size("ids") < size).groupBy("batch_id").agg(members.alias("members"))
    merged = merged.select("batch_id", F.col("members.ids").alias("ids"), F.col("members.queries").alias("queries"))
    return whole.unionByName(merged.select("batch_id", n_queries, "ids", "queries"))


def _batches_reshuffled(texts: DataFrame, runs: list[Run], size: int, n: int) -> DataFrame:
    """Batches in hash order, of texts with ids of their own. Every text goes once
    per run to the bucket of its hash, and is sorted there; what comes before a bucket
    is a running sum over bucket counts. Batches that reach over the end of a bucket
    are put together from their pieces."""
    digits = _digits(n, BUCKET_TEXTS)
    seeds = F.array(*[F.lit(run.seed) for run in runs])
    names = F.array(*[F.lit(run.name) for run in runs])
    level = F.conv(F.substring(shuffle_key(F.col("__seed"), F.col("UniqueID")), 1, digits), 16, 10)
    bucket = F.col("__run") * F.lit(16**digits) + level.cast("int")
    dealt = texts.select("UniqueID", "Query", F.posexplode(seeds).alias("__run", "__seed")).select(
        bucket.alias("__bucket"), "UniqueID", "Query"
    )
    run = F.expr(f"__bucket div {16**digits}").cast("int")
    earlier = Window.partitionBy(run).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = counts.select("__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))

    # The keys are made once more behind the shuffle, as they hardly compress.
    key = shuffle_key(seeds[run], F.col("UniqueID")).alias("key")
    sorted_ = F.sort_array(F.collect_list(F.struct(key, "UniqueID", "Query")))
    gathered = dealt.repartition("__bucket").groupBy("__bucket").agg(sorted_.alias("members"))
    # A row per bucket of a run, 65,536 at most: no whole bucket is sorted for this join.
    gathered = gathered.join(F.broadcast(before), "__bucket")

    def piece(batch: Column) -> Column:
        begin = F.greatest(batch * size - F.col("__before"), F.lit(0)).cast("int")
        end = ((batch + 1) * size - F.col("__before")).cast("int")
        members = F.slice("members", begin + 1, end - begin)
        return F.struct(batch.alias("batch_id"), members["UniqueID"].alias("ids"), members["Query"].alias("queries"))

    last = F.col("__before") + F.size("members") - 1
    batches = F.sequence(F.expr(f"__before div {size}"), F.floor(last / size).cast("long"))
    pieces = gathered.select("__bucket", F.inline(F.transform(batches, piece)))
    name, n_queries = names[run].alias("run_name"), F.size("ids").alias("n_queries")
    whole = pieces.where(F.size("ids") == size).select(name, "batch_id", n_queries, "ids", "queries")
    parts = F.array_sort(F.collect_list(F.struct("__bucket", "ids", "queries")))
    rest = pieces.where(F.size("ids") < size).groupBy(name, "batch_id").agg(parts.alias("parts"))
    merged = rest.select(
        "run_name", "batch_id",
        F.flatten("parts.ids").alias("ids"), F.flatten("parts.queries").alias("queries"),
    )
    return whole.unionByName(merged.select("run_name", "batch_id", n_queries, "ids", "queries"))


def make_batches(
    distinct: DataFrame, runs: list[Run], size: int = BATCH_SIZE
) -> DataFrame:
    """The same straight from the texts: all unseeded runs have the same batches, so
    these are collected once and repeated per run afterwards; of seeded runs every
    text is moved once. Where ids repeat or are missing, batches are collected from
    the assigned texts."""
    texts = distinct.select("UniqueID", "Query")
    plain, seeded = _split_runs(runs)
    n, own_ids = _count_ids(texts)
    parts = []
    if plain:
        shared = _batches_in_order(texts, size) if own_ids else _collect(_cut(texts, "UniqueID", size), "batch_id")
        parts.append(run_matrix(shared, plain).drop("seed"))
    if seeded:
        parts.append(
            _batches_reshuffled(texts, seeded, size, n) if own_ids else collect_batches(_cut_seeded(texts, seeded, size))
        )
    return _union(parts)


def render_prompts(batches: DataFrame, preamble: str = DEFAULT_PREAMBLE) -> DataFrame:
    """Add ``prompt``: the preamble, then one ``- text`` line per query."""
    lines = F.concat(F.lit("- "), F.array_join("queries", "\n- "), F.lit("\n"))
    return batches.withColumn("prompt", F.concat(F.lit(preamble), lines))


def without_listed_texts(rendered: DataFrame, preamble: str = DEFAULT_PREAMBLE) -> DataFrame:
    """Rendered prompts as they are stored: ``queries`` is null where the lines of the
    prompt say them, character by character, and ``lead`` is the length of what stands
    before the first."""
    lead = F.lit(len(preamble) + 2)
    listed = _listed_texts(F.col("prompt"), lead)
    return rendered.withColumns({"queries": F.when(~listed.eqNullSafe(F.col("queries")), F.col("queries")), "lead": lead})


def with_listed_texts(requests: DataFrame) -> DataFrame:
    """The same prompts with all their ``queries``."""
    if "lead" not in requests.columns:
        return requests
    queries = F.coalesce("queries", _listed_texts(F.col("prompt"), F.col("lead")))
    return requests.withColumn("queries", queries).drop("lead")


def _listed_texts(prompt: Column, lead: Column) -> Column:
    """The lines of a prompt; a text with a line of its own gives others than it has."""
    return F.split(F.substring(prompt, lead + 1, F.length(prompt) - lead - 1), "\n- ")


def batch_sizes(assigned: DataFrame) -> DataFrame:
    """Number of texts in every batch."""
    return assigned.groupBy("run_name", "batch_id").agg(F.count("*").alias("n_queries"))
