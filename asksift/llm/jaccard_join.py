"""N-gram Jaccard join by chosen paths.

Every document is a set of word shingles. A run sends a set along random paths:
at a node a set goes on to one child per shingle whose hash, taken with the
node, is below a threshold of about ``BRANCH`` children per set; similar sets
choose common shingles and so meet. Equal sets are one class from the start.

A node's members are first compared with one of them, the pivot, by sketch:
members like it are linked to it, and the very like ones are done there, so a
group of near copies costs a row each. What is left of a small node is compared
by brute force; a larger node is split again by its members' next shingles, and
at the last depth compared in blocks. Runs are repeated until a pair right at
the threshold is met with the target probability.

All that yields links of candidates only. Their components are then compared
exactly, shingle set by shingle set, so links and counts are exact.

Null and empty texts, and texts without words, have the empty set; all of these
are copies of each other. A text of fewer words than a shingle is one shingle.
Repeated rows are copies. Rows that share an id, or have none, are told apart by
the hash of their text. A null id comes before all others. Extra columns are
ignored by the join and pass through ``keep_one_of_each_group``, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import drop_stages, require_columns, shared_folder, stage
from .components import connected_components, salted_join, trees
from .verification import groups_in_order, link_members
from .words import (
    mixed, runs_of_texts, set_keys, set_minima, shingle_hashes, shingle_sets, text_buffers, unused, word_hashes,
)

SHINGLE_WORDS = 5
#: Similarity of a link, in tenths.
TENTHS = 8
#: Expected common children of a pair right at the threshold.
BRANCH = 3.0
TARGET_RECALL = 0.9999
MAX_DEPTH = 3
SMALL_NODE = 64
#: Members of a block against those of a small node; a member is sent once per block.
BLOCK_NODES = 32
SKETCH_SIZE = 64
#: Estimated similarity from which a member is linked to a pivot, and from which
#: it needs no other: whatever it links to is then linked to the pivot as well.
LINK_FROM, DONE_FROM = 0.25, 0.65
FIRST_ID = -(1 << 63)
EMPTY_SET = 0

_random = np.random.default_rng(4)
_SKETCH = _random.integers(0, 1 << 63, SKETCH_SIZE, dtype=np.uint64) * 2 + 1
_RUN = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * 2 + 1
_CHOICE = np.uint64(0x9E3779B97F4A7C15)
_CHILD = np.uint64(0xC2B2AE3D27D4EB4F)


def runs_needed(target: float = TARGET_RECALL, branch: float = BRANCH, depth: int = MAX_DEPTH) -> int:
    """Runs until a pair at the threshold meets with probability ``target``: its
    common paths branch like a Poisson process that must last ``depth`` levels."""
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(-branch * (1 - lost))
    return max(1, math.ceil(math.log(1 - target) / math.log(lost)))


def children(tokens: np.ndarray, node: np.uint64, tenths: int = TENTHS) -> np.ndarray:
    """The children that a set chooses at a node."""
    if not len(tokens):
        return tokens
    share = min(1.0, BRANCH * 10 / (tenths * len(tokens)))
    drawn = mixed((tokens ^ node) * _CHOICE)
    chosen = tokens[drawn <= np.uint64(min(share * 2.0**64, 2.0**64 - 2049))]
    return mixed(chosen * _CHILD + node)


def first_nodes(tokens: np.ndarray, ends: np.ndarray, runs: int, tenths: int = TENTHS) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that many sets choose first, in all runs, set by set; and the
    n+1 places where those of a set begin."""
    sizes = np.diff(ends)
    share = np.minimum(1.0, BRANCH * 10 / (tenths * np.maximum(sizes, 1)))
    limits = np.minimum(share * 2.0**64, 2.0**64 - 2049).astype(np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    limit = limits[owner]
    nodes, owners = [], []
    for node in _RUN[:runs]:
        chosen = mixed((tokens ^ node) * _CHOICE) <= limit
        nodes.append(mixed(tokens[chosen] * _CHILD + node))
        owners.append(owner[chosen])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    places = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))])
    return np.concatenate(nodes)[order], places


def sketches(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per set, sixteen bits of its minimum under each of many hashes."""
    out = np.zeros((len(ends) - 1, SKETCH_SIZE), np.uint16)
    some = np.flatnonzero(np.diff(ends))
    low = set_minima(tokens ^ (tokens >> np.uint64(31)), np.append(ends[some], len(tokens)), _SKETCH)
    out[some] = (mixed(low) >> np.uint64(48)).astype(np.uint16)
    return out


def token_runs(column: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a column, the sorted shingle sets of their texts in one
    array, and the n+1 places where they begin."""
    data, offsets = text_buffers(column)
    for first, last in runs_of_texts(offsets):
        hashes, places = shingle_hashes(*word_hashes(data, offsets[first : last + 1]), size)
        yield first, last, *shingle_sets(hashes, places)


def token_sets(column: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted shingle set of every text of a column."""
    for _, _, tokens, ends in token_runs(column, size):
        for a, b in zip(ends[:-1], ends[1:]):
            yield tokens[a:b]


def set_key(tokens: np.ndarray) -> int:
    """A 63-bit name of a set."""
    return int(set_keys(tokens, np.array([0, len(tokens)]))[0])


def named_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, name, text``: nulls filled, and the hash of the text, which tells
    rows apart that share an id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc_id"),
        F.xxhash64(text).alias("name"),
        text.alias("text"),
    )


ENTRY_SCHEMA = "doc_id long, name long, class long, size int, nodes array<long>, sketch binary"


def enter_sets(docs: DataFrame, runs: int, size: int = SHINGLE_WORDS, tenths: int = TENTHS) -> DataFrame:
    """Per document its class, set size, first nodes of all runs, and sketch."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, tokens, ends in token_runs(batch.column(2), size):
                nodes, places = first_nodes(tokens, ends, runs, tenths)
                marks = sketches(tokens, ends).tobytes()
                width = 2 * SKETCH_SIZE
                columns = [
                    batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                    pa.array(set_keys(tokens, ends)), pa.array(np.diff(ends).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(nodes.astype(np.int64))),
                    pa.array([marks[i : i + width] for i in range(0, len(marks), width)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "name", "class", "size", "nodes", "sketch"])

    return named_texts(docs).mapInArrow(enter, ENTRY_SCHEMA)


def _agreement(a: str, b: str) -> F.Column:
    @F.arrow_udf("double")
    def agree(left: pa.Array, right: pa.Array) -> pa.Array:
        def matrix(column: pa.Array) -> np.ndarray:
            joined = b"".join(column.to_pylist())
            return np.frombuffer(joined, np.uint16).reshape(-1, SKETCH_SIZE)

        return pa.array((matrix(left) == matrix(right)).mean(1))

    return agree(F.col(a), F.col(b))


def _pivot_links(rows: DataFrame) -> DataFrame:
    """Members of nodes with the pivot of their node and their likeness to it.
    The pivot is the smallest class, found by a combining aggregate."""
    pivots = rows.groupBy("node").agg(
        F.min(F.struct("class", "sketch")).alias("p"), F.count("*").alias("n")
    )
    small = pivots.where("n > 1").select("node", F.col("p.class").alias("pivot"), F.col("p.sketch").alias("pivot_sketch"))
    joined = salted_join(rows, small, ["node"], "class")
    return joined.withColumn("like", _agreement("sketch", "pivot_sketch")).drop("pivot_sketch")


def _brute_force(rows: DataFrame) -> DataFrame:
    """Links of candidates within nodes, by sketch; ``n`` is the size of a row's
    node. A node larger than a block is compared in pairs of blocks."""
    blocks = F.ceil(F.col("n") / (BLOCK_NODES * SMALL_NODE)).cast("int")
    placed = rows.withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "class", "sketch",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_in_order(batches, ["node", "low", "high"]):
            ids = table.column("class").to_numpy()
            marks = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16)
            marks = marks.reshape(-1, SKETCH_SIZE)
            left, right = [], []
            for i in range(len(ids) - 1):
                near = np.flatnonzero((marks[i + 1 :] == marks[i]).mean(1) >= LINK_FROM)
                left.append(np.full(len(near), ids[i]))
                right.append(ids[i + 1 + near])
            if left:
                found = trees(np.concatenate(left), np.concatenate(right))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b"])

    spread = paired.repartition("node", "low", "high").sortWithinPartitions("node", "low", "high")
    return spread.mapInArrow(compare, "a long, b long")


def _split(rows: DataFrame, sets: DataFrame, tenths: int) -> DataFrame:
    """The children that the members of large nodes choose; they differ, as a set's
    shingles do."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy().astype(np.uint64)
            found = [
                children(np.frombuffer(t.as_py(), np.uint64), n, tenths).astype(np.int64)
                for n, t in zip(nodes, batch.column("tokens"))
            ]
            counts = np.array([len(f) for f in found])
            if not counts.sum():
                continue
            at = pa.array(np.repeat(np.arange(len(found)), counts))
            columns = [pa.array(np.concatenate(found)), batch.column("class").take(at), batch.column("sketch").take(at)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "class", "sketch"])

    joined = rows.join(sets.hint("merge"), "class").select("node", "class", "sketch", "tokens")
    return joined.mapInArrow(expand, "node long, class long, sketch binary")


def candidate_links(classes: DataFrame, sets, folder: str, tenths: int = TENTHS) -> DataFrame:
    """Edges between classes that met and look alike.

    ``sets`` gives the shingle sets of some classes when a level needs them; the
    rows of a level are those of nodes with more than one member. Members are joined
    to the sizes of their nodes once, for both the small nodes and the large ones.
    """
    spark = classes.sparkSession
    entered = classes.select(F.explode(F.array_distinct("nodes")).alias("node"), "class")
    met = entered.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    shared = salted_join(entered, met, ["node"], "class")
    rows = shared.join(classes.select("class", "sketch"), "class").select("node", "class", "sketch")
    found = []
    for depth in range(1, MAX_DEPTH + 1):
        compared = stage(_pivot_links(rows), f"{folder}/depth-{depth}")
        links = compared.where((F.col("like") >= LINK_FROM) & (F.col("class") != F.col("pivot")))
        links = links.select(F.col("class").alias("a"), F.col("pivot").alias("b"))
        left = compared.where((F.col("class") != F.col("pivot")) & (F.col("like") < DONE_FROM))
        left = left.select("node", "class", "sketch")
        sizes = left.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        sized = stage(salted_join(left, sizes, ["node"], "class"), f"{folder}/sized-{depth}")
        limit = SMALL_NODE if depth < MAX_DEPTH else 1 << 62
        links = links.unionByName(_brute_force(sized.where(F.col("n") <= limit)))
        found.append(stage(links, f"{folder}/links-{depth}"))
        drop_stages(spark, f"{folder}/depth-{depth}")
        large = sized.where(F.col("n") > limit)
        if depth == MAX_DEPTH or large.isEmpty():
            break
        rows = _split(large, sets(large.select("class").distinct()), tenths)
    edges = found[0]
    for links in found[1:]:
        edges = edges.unionByName(links)
    return edges


def jaccard_join(docs: DataFrame, size: int = SHINGLE_WORDS, tenths: int = TENTHS) -> DataFrame:
    """Per document row: ``doc_id, class_id`` (the smallest id of its group of
    linked documents), ``set_id`` (the smallest id with an equal set),
    ``n_links`` (other documents that are at least as similar as asked, copies
    included) and ``n_linked_sets`` (different sets among them)."""
    return _joined(docs, size, tenths).drop("name", "first")


def _joined(docs: DataFrame, size: int, tenths: int) -> DataFrame:
    """The same with each row's text name, and ``first``: is it the first document
    of its group?"""
    require_columns(docs, "doc_id", "text")
    folder = shared_folder(docs.sparkSession)
    entries = stage(enter_sets(docs, runs_needed(), size, tenths), f"{folder}/entries")
    classes = stage(
        entries.groupBy("class").agg(
            F.min(F.struct("doc_id", "name")).alias("rep"), F.count("*").alias("copies"),
            F.first("nodes").alias("nodes"), F.first("sketch").alias("sketch"),
        ),
        f"{folder}/classes",
    )

    read: list[str] = []

    def sets(wanted: DataFrame) -> DataFrame:
        named = wanted.join(classes.select("class", "rep"), "class")
        read.append(f"{folder}/sets-{len(read)}")
        return stage(_sets_of_classes(docs, named, size), read[-1])

    edges = candidate_links(classes, sets, f"{folder}/paths", tenths)
    groups = connected_components(edges)
    groups = stage(groups.select(F.col("node").alias("class"), F.col("component").alias("group")), f"{folder}/groups")
    members = (
        groups.join(sets(groups.select("class")), "class")
        .join(classes.select("class", "copies"), "class")
        .select("group", F.col("class").alias("id"), F.col("copies").alias("weight"), "tokens")
    )
    links = stage(link_members(members, tenths), f"{folder}/links")
    degrees = links.groupBy("id").agg(F.sum("links").alias("links"), F.sum("linked_weight").alias("linked"))
    found = connected_components(links.select(F.col("id").alias("a"), F.col("head").alias("b")))
    heads = (
        found.join(classes.select(F.col("class").alias("node"), "rep"), "node")
        .groupBy("component")
        .agg(F.min(F.struct("rep", "node")).alias("first"))
    )
    grouped = salted_join(found, heads, ["component"], "node").select(
        F.col("node").alias("id"), F.col("first.rep").alias("head")
    )
    judged = (
        classes.select(F.col("class").alias("id"), "rep", "copies")
        .join(degrees, "id", "left")
        .join(grouped, "id", "left")
        .select(
            F.col("id").alias("class"),
            F.coalesce("head", "rep").alias("head"),
            F.col("rep.doc_id").alias("set_id"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_linked_sets"),
        )
    )
    judged = stage(judged, f"{folder}/judged")
    drop_stages(docs.sparkSession, *[f"{folder}/{name}" for name in ("classes", "paths", "groups", "links")], *read)
    out = salted_join(entries.select("doc_id", "name", "class"), judged, ["class"], "doc_id")
    out = out.withColumn("class_id", F.col("head.doc_id"))
    unnamed = [F.nullif(c, F.lit(FIRST_ID)).alias(c) for c in ("doc_id", "class_id", "set_id")]
    first = F.struct("doc_id", "name") == F.col("head")
    return out.select(*unnamed, "n_links", "n_linked_sets", "name", first.alias("first"))


def _sets_of_classes(docs: DataFrame, named: DataFrame, size: int) -> DataFrame:
    """``class, tokens`` of the wanted classes, each read from its first document
    (``rep``, an id and a text name)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t.tobytes() for t in token_sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["class", "tokens"])

    wanted = named.select("class", F.col("rep.doc_id").alias("doc_id"), F.col("rep.name").alias("name"))
    # Repeated rows go where the texts meet their classes, so no set is moved for it.
    texts = named_texts(docs).join(wanted, ["doc_id", "name"]).dropDuplicates(["doc_id", "name", "class"])
    return texts.select("class", "text").mapInArrow(sets, "class long, tokens binary")


def keep_one_of_each_group(docs: DataFrame, size: int = SHINGLE_WORDS, tenths: int = TENTHS) -> DataFrame:
    """The document with the smallest id of each group of linked documents. Rows
    that only share an id, or have none, are documents of their own; of rows with
    equal id and equal text, one stays."""
    doc_id, name = unused(docs.columns, "__id"), unused(docs.columns, "__name")
    first = _joined(docs, size, tenths).where("first")
    first = first.select(F.coalesce("doc_id", F.lit(FIRST_ID)).alias(doc_id), F.col("name").alias(name)).distinct()
    named = docs.withColumns(
        {
            doc_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)),
            name: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))),
        }
    )
    found = named.join(first, [doc_id, name], "left_semi").dropDuplicates([doc_id, name])
    return found.select(*docs.columns)
