"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch keeps the k smallest hashes of a text's shingle set, sorted. Sketches
of parts merge into the sketch of the whole, and two sketches estimate
resemblance, containment and the number of distinct shingles. A text with at
most k distinct shingles has an exact sketch. Null and empty texts, and texts
without words, have the empty sketch; two empty sketches are alike. Hashes that tie
are one shingle. Repeated rows, and rows with equal or no ids, are fingerprinted one
by one, in the order of id and text. Extra columns are ignored, whatever their names,
and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.stages import require_columns
from .words import runs_of_texts, shingle_hashes, text_buffers, word_hashes

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
#: Hashes are kept to 48 bits, six bytes each.
HASH_BITS = 48


def sketches(column: pa.Array, k: int = SKETCH_SIZE, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The bottom-k sketch of every text of an Arrow column."""
    data, offsets = text_buffers(column)
    out = []
    for first, last in runs_of_texts(offsets):
        words, firsts = word_hashes(data, offsets[first : last + 1])
        hashes, places = shingle_hashes(words, firsts, size)
        hashes >>= np.uint64(64 - HASH_BITS)
        out += [smallest(hashes[a:b], k) for a, b in zip(places[:-1], places[1:])]
    return out


def smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values, sorted."""
    return np.unique(hashes)[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> np.ndarray:
    """The sketch of two parts' union."""
    return smallest(np.concatenate([a, b]), k)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated Jaccard similarity: the share of the union's sketch that both
    have. Two empty sketches are alike; an empty one is unlike any other."""
    both = np.sort(np.concatenate([a, b]))
    if not len(both):
        return 1.0
    new = np.append(True, both[1:] != both[:-1])
    distinct = min(int(new.sum()), k)
    last = np.flatnonzero(new)[distinct - 1]
    end = last + 1 + (last + 1 < len(both) and not new[last + 1])
    return float((end - distinct) / distinct)


def distinct_shingles(a: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated number of distinct shingles; exact below k."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) * float(1 << HASH_BITS) / float(a[k - 1] + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated share of a's shingles that b has; an empty a is contained."""
    if not len(a):
        return 1.0
    if len(a) < k and len(b) < k:
        return float(np.isin(a, b).mean())
    j = resemblance(a, b, k)
    na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
    return min(1.0, j / (1 + j) * (na + nb) / na)


def as_text(sketch: np.ndarray) -> str:
    """A sketch as base64 of its six-byte big-endian hashes."""
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.b64encode(raw.tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def fingerprint_texts(
    docs: DataFrame, text: str = "text", k: int = SKETCH_SIZE, size: int = SHINGLE_WORDS,
    into: str = "sketch",
) -> DataFrame:
    """Add the sketch of a text column as ``into``, an array of hashes. Other
    columns pass through; one named ``into`` is refused."""
    require_columns(docs, text)
    if into in docs.columns:
        raise ValueError(f"column already there: {into}")

    @F.arrow_udf("array<long>")
    def sketch(column: pa.Array) -> pa.Array:
        values = [s.astype(np.int64) for s in sketches(column, k, size)]
        return pa.array(values, pa.list_(pa.int64()))

    return docs.withColumn(into, sketch(F.col(text).cast("string")))


def merge_sketches(
    parts: DataFrame, by: list[str], sketch: str = "sketch", k: int = SKETCH_SIZE
) -> DataFrame:
    """One sketch per group of parts.

    Equal hashes are combined first and each task passes on at most k rows per
    group, so a group that holds most parts costs little more than any other.
    """
    require_columns(parts, *by, sketch)
    hashes = parts.select(*by, F.explode(sketch).alias("__hash")).distinct()
    lowest = Window.partitionBy(*by).orderBy("__hash")
    kept = hashes.withColumn("__rank", F.row_number().over(lowest)).where(F.col("__rank") <= k)
    found = kept.groupBy(*by).agg(F.sort_array(F.collect_list("__hash")).alias("__merged"))
    groups = parts.select(*by).distinct().alias("g")
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]
    return groups.join(found.alias("m"), same, "left").select(
        *[F.col(f"g.{c}") for c in by],
        F.coalesce("m.__merged", F.array().cast("array<long>")).alias(sketch),
    )


# --- fingerprints of texts and of their edited neighbours ---------------------

EDITED_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
FIRST_ID = -(1 << 63)


def _id_ranges(ids: DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds of at most ``ranges`` ranges of ids that hold about as many
    rows each, and the smallest id in each; both as many as there are ranges."""
    steps = [i / ranges for i in range(1, ranges)]
    found = ids.agg(F.percentile_approx("doc_id", steps, 10_000).alias("b")).first()["b"] if steps else []
    bounds = np.unique(np.array([FIRST_ID, *(found or [])], np.int64))
    array = bounds.tolist()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, int] = {}
        for batch in batches:
            values = np.sort(batch.column(0).to_numpy(zero_copy_only=False))
            place = np.searchsorted(np.array(array, np.int64), values, "right") - 1
            for p in np.unique(place):
                first = int(values[np.searchsorted(place, p)])
                low[int(p)] = min(low.get(int(p), first), first)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(low), pa.int64()), pa.array(list(low.values()), pa.int64())],
            ["range", "first"],
        )

    rows = (
        ids.mapInArrow(of, "range long, first long")
        .groupBy("range").agg(F.min("first").alias("first")).orderBy("first").collect()
    )
    return bounds[[r["range"] for r in rows]], np.array([r["first"] for r in rows], np.int64)


def fingerprint_edits(docs: DataFrame, k: int = SKETCH_SIZE, size: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprint every text and the text whose last floor(n/2) characters are
    replaced by the first as many of the next document.

    Documents follow each other by ``doc_id``, then text; a null id comes
    first, and the last document is followed by the first. Texts move once:
    they are dealt into ranges of ids, where each range also gets the document
    that opens the next one, and are read in order as a stream. Ranges are as
    many as ``spark.sql.shuffle.partitions``.
    """
    require_columns(docs, "doc_id", "text")
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    bounds, firsts = _id_ranges(picked.select("doc_id"), ranges)
    count = len(bounds)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            place = (np.searchsorted(bounds, ids, "right") - 1).astype(np.int64)
            opens = np.flatnonzero(ids == firsts[place])
            yield _ranged(batch, place, np.zeros(len(ids), bool))
            if len(opens):
                before = (place[opens] - 1) % count
                yield _ranged(batch.take(pa.array(opens)), before, np.ones(len(opens), bool))

    def _ranged(batch: pa.RecordBatch, place: np.ndarray, tail: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(tail), *batch.columns],
            ["range", "tail", "doc_id", "text"],
        )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            rows = table.num_rows
            held = table.slice(rows - 1).combine_chunks().to_batches()[0]
            tail = table.column("tail").to_numpy()
            own = np.flatnonzero(~tail[:-1])
            if len(own):
                yield _edited(table, own, k, size)

    moved = picked.mapInArrow(dealt, "range int, tail boolean, doc_id long, text string")
    ordered = moved.repartitionById(ranges, F.col("range")).sortWithinPartitions(
        "range", "tail", "doc_id", "text"
    )
    out = ordered.mapInArrow(follow, EDITED_SCHEMA)
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(FIRST_ID)))


def _edited(table: pa.Table, own: np.ndarray, k: int, size: int) -> pa.RecordBatch:
    """The result rows of ``own``, each of which is followed by its next."""
    column = table.column("text").combine_chunks()
    prints = sketches(column, k, size)
    texts = column.to_pylist()
    edited = []
    for i in own:
        text, half = texts[i], len(texts[i]) // 2
        edited.append(text[: len(text) - half] + texts[i + 1][:half])
    changed = sketches(pa.array(edited, pa.large_string()), k, size)
    doc_ids = table.column("doc_id").combine_chunks().take(pa.array(own))
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array([as_text(prints[i]) for i in own]),
            pa.array([as_text(s) for s in changed]),
            pa.array([resemblance(prints[i], s, k) for i, s in zip(own, changed)], pa.float64()),
            pa.array([resemblance(prints[i], prints[i + 1], k) for i in own], pa.float64()),
        ],
        [f.split()[0] for f in EDITED_SCHEMA.split(", ")],
    )
