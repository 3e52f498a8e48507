"""Hard negatives by exact scores from a residue number system.

Vectors of whole numbers are held modulo several primes, so small that a matrix
product of residues in float32 is exact (every sum stays below 2^24). The products
modulo each prime give the signed inner product by Chinese remaindering. The
primes are chosen for the longest vector and the largest possible score.

For every anchor the first rows of its own label, by score, are its positives; for
each positive the first rows of other labels whose score lies in a window below
the positive's are its hard negatives. Higher scores come first, ties by smaller
id, a null id before all others.

Rows are dealt into blocks of bounded size by hash, and every anchor is sent to
every block; a task holds one block and streams the anchors past it. It sends back
the first few rows per anchor (and positive) only, which then meet by anchor. So
nothing but those is ever a row, and neither anchors nor rows are broadcast.

Rows with a null label, a null vector, or a null or non-finite component take no
part. Vectors shorter than the longest count as filled up with zeros. Rows that
share an id, or have none, and repeated rows are rows of their own: an anchor's
equal is another row. Extra columns are ignored, whatever their names. An empty
table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.stages import counted_stage, require_columns, shared_folder, stage
from .vectors import FIRST_ID, known_ids, matrix_of, squared_norm, whole_vectors

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score against its positive's, in hundredths.
WINDOW = (80, 100)
#: A sum of products of residues stays below that, and so is exact in float32.
EXACT = 1 << 24
#: Columns of one product; wider vectors are multiplied piece by piece.
PIECE = 4096
#: Components in one block of rows, rows of a block compared at once, and anchors
#: at once.
BLOCK_CELLS = 1 << 23
TILE_ROWS = 1 << 13
TILE_ANCHORS = 128
#: No more blocks than shuffle partitions for blocks smaller than that.
SMALL_BLOCK = 1 << 11


def choose_primes(width: int, bound: int) -> list[int]:
    """The largest primes whose residues multiply exactly, until their product
    holds every score from ``-bound`` to ``bound``."""
    if bound >= 1 << 51:
        raise ValueError("scores of 2^51 or more")
    most = max(1, min(width, PIECE))
    primes: list[int] = []
    product, p = 1, 2 * int((EXACT / most) ** 0.5) + 1
    while product <= 2 * bound:
        p -= 1
        if p < 3:
            raise ValueError("too few primes")
        half = p // 2
        if most * half * half + p <= EXACT and all(p % q for q in range(2, int(p**0.5) + 1)):
            primes.append(p)
            product *= p
    return primes


def residues(values: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Per prime the signed residues of least size."""
    found = []
    for p in primes:
        r = values % p
        found.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return found


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """All inner products of two sets of rows, given their residues."""
    total, size = np.zeros((len(left[0]), len(right[0])), np.int64), 1
    for p, a, b in zip(primes, left, right):
        r = np.zeros_like(total)
        for low in range(0, a.shape[1], PIECE):
            r += (a[:, low : low + PIECE] @ b[:, low : low + PIECE].T).astype(np.int64) % p
        # The digit of the next prime in mixed radix.
        total += (r - total) * pow(size, -1, p) % p * size
        size *= p
    return np.where(total > size // 2, total - size, total)


def first_of_each(group: np.ndarray, score: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """Where the first entries of every group are: higher scores first, then
    smaller places."""
    order = np.lexsort((place, -score, group))
    grouped = group[order]
    new = np.append(True, grouped[1:] != grouped[:-1])[: len(grouped)]
    head = np.maximum.accumulate(np.where(new, np.arange(len(grouped)), 0))
    return order[np.arange(len(grouped)) - head < most]


class Block(NamedTuple):
    """Rows in the order of their ids; a smaller place wins a tie."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    residues: list[np.ndarray]

    @staticmethod
    def of(batches: list[pa.RecordBatch], width: int, primes: list[int]) -> Block:
        table = pa.Table.from_batches(batches).combine_chunks()
        row, label = (table.column(c).to_numpy() for c in ("row", "label"))
        vec_id = known_ids(table.column("vec_id").combine_chunks())
        order = np.lexsort((row, vec_id))
        values = matrix_of(table.column("values").combine_chunks(), width)[order]
        return Block(row[order], vec_id[order], label[order], residues(values, primes))

    def tiles(self) -> Iterator[tuple[slice, list[np.ndarray]]]:
        for low in range(0, len(self.row), TILE_ROWS):
            part = slice(low, low + TILE_ROWS)
            yield part, [r[part] for r in self.residues]


def _met(batches: Iterator[pa.RecordBatch], width: int, primes: list[int]) -> Iterator[tuple[Block, pa.RecordBatch]]:
    """Each block with the anchors that pass it, a few at a time. In sorted batches
    the rows of a block come before its anchors."""
    held: list[pa.RecordBatch] = []
    block, number = None, None
    for batch in batches:
        numbers = batch.column("block").to_numpy()
        anchors = batch.column("anchor").to_numpy(zero_copy_only=False)
        change = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(anchors.astype(np.int8)) != 0)) + 1
        cuts = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if numbers[a] != number:
                held, block, number = [], None, numbers[a]
            part = batch.slice(a, b - a)
            if not anchors[a]:
                held.append(part)
                continue
            if block is None and held:
                block, held = Block.of(held, width, primes), []
            if block is not None:
                for low in range(0, part.num_rows, TILE_ANCHORS):
                    yield block, part.slice(low, TILE_ANCHORS)


POSITIVE_SCHEMA = "anchor long, vec_id long, row long, score long"
NEGATIVE_SCHEMA = "anchor long, positive int, vec_id long, row long, score long"


def _sent(rows: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Rows and anchors by block. Anchors may have further columns."""
    number = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    extra = [c for c in anchors.columns if c not in rows.columns]
    here = rows.select(number.alias("block"), F.lit(False).alias("anchor"), *rows.columns, *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in extra])
    there = anchors.select(every.alias("block"), F.lit(True).alias("anchor"), *rows.columns, *extra)
    return here.unionByName(there).repartition("block").sortWithinPartitions("block", "anchor")


def _positives(rows: DataFrame, anchors: DataFrame, blocks: int, width: int, primes: list[int], most: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in _met(batches, width, primes):
            me, label = part.column("row").to_numpy(), part.column("label").to_numpy()
            mine = residues(matrix_of(part.column("values"), width), primes)
            found = []
            for where, theirs in block.tiles():
                score = products(mine, theirs, primes)
                fit = (label[:, None] == block.label[where]) & (me[:, None] != block.row[where])
                if score.shape[1] > most:
                    low = np.iinfo(np.int64).min
                    least = np.partition(np.where(fit, score, low), -most, axis=1)[:, -most]
                    fit &= score >= least[:, None]
                anchor, place = np.nonzero(fit)
                found.append((anchor, place + where.start, score[anchor, place]))
            anchor, place, score = (np.concatenate(x) for x in zip(*found))
            at = first_of_each(anchor, score, place, most)
            columns = [me[anchor[at]], block.vec_id[place[at]], block.row[place[at]], score[at]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "vec_id", "row", "score"])

    met = _sent(rows, anchors, blocks).mapInArrow(find, POSITIVE_SCHEMA)
    return _first(met, most, "anchor")


def _negatives(
    rows: DataFrame, anchors: DataFrame, blocks: int, width: int, primes: list[int], most: int, window: tuple[int, int]
) -> DataFrame:
    """``anchors`` have ``scores``, those of their positives in order."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in _met(batches, width, primes):
            me, label = part.column("row").to_numpy(), part.column("label").to_numpy()
            mine = residues(matrix_of(part.column("values"), width), primes)
            given = part.column("scores").to_pylist()
            slots = max(map(len, given))
            # An impossible window where an anchor has fewer positives.
            low, high = np.ones((slots, len(me)), np.int64), np.zeros((slots, len(me)), np.int64)
            for i, scores in enumerate(given):
                for j, s in enumerate(scores):
                    low[j, i], high[j, i] = window[0] * s, window[1] * s
            none = low > high
            lowest = np.where(none, np.iinfo(np.int64).max, low).min(0)
            highest = np.where(none, np.iinfo(np.int64).min, high).max(0)
            found: list[list] = [[] for _ in range(slots)]
            for where, theirs in block.tiles():
                score = products(mine, theirs, primes)
                scaled = 100 * score
                fit = (scaled >= lowest[:, None]) & (scaled <= highest[:, None])
                fit &= label[:, None] != block.label[where]
                anchor, place = np.nonzero(fit)
                score, scaled = score[anchor, place], scaled[anchor, place]
                for j in range(slots):
                    ok = np.flatnonzero((scaled >= low[j][anchor]) & (scaled <= high[j][anchor]))
                    at = ok[first_of_each(anchor[ok], score[ok], place[ok], most)]
                    found[j].append((anchor[at], place[at] + where.start, score[at]))
            for j in range(slots):
                anchor, place, score = (np.concatenate(x) for x in zip(*found[j]))
                at = first_of_each(anchor, score, place, most)
                columns = [
                    me[anchor[at]], np.full(len(at), j, np.int32), block.vec_id[place[at]],
                    block.row[place[at]], score[at],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["anchor", "positive", "vec_id", "row", "score"]
                )

    met = _sent(rows, anchors, blocks).mapInArrow(find, NEGATIVE_SCHEMA)
    return _first(met, most, "anchor", "positive")


def _first(met: DataFrame, most: int, *keys: str) -> DataFrame:
    """The first entries per key with their ``rank``. A key has a few per block."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "row")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_hard_negatives(
    df: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the rows of ``df`` where ``anchors`` holds.

    Scores are inner products of the vectors times ``scale``, rounded down. Labels
    may be of any type. A negative's score lies between the two hundredths of the
    positive's score in ``window``, both included.
    """
    require_columns(df, vec_id, label, vector)
    spark = df.sparkSession
    folder = shared_folder(spark)
    picked = df.where(F.col(label).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.xxhash64(label).alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("asked"),
    )
    whole = whole_vectors(picked, "vector", scale).drop("vector")
    whole, seen = counted_stage(
        whole, f"{folder}/vectors", n=F.count("*"),
        width=F.max(F.size("values")), bound=F.max(squared_norm("values")),
    )
    width = max(1, seen["width"] or 0)
    primes = choose_primes(width, seen["bound"] or 0)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-seen["n"] * width // BLOCK_CELLS), min(partitions, -(-seen["n"] // SMALL_BLOCK)))
    rows = whole.drop("asked")
    asking = whole.where("asked").drop("asked")
    best = stage(_positives(rows, asking, blocks, width, primes, positives), f"{folder}/positives")
    listed = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("best"))
    known = asking.join(listed, asking["row"] == listed["anchor"]).select(*rows.columns, "best")
    known = stage(known, f"{folder}/anchors")
    with_scores = known.select(*rows.columns, F.col("best.score").alias("scores"))
    found = _negatives(rows, with_scores, blocks, width, primes, negatives, window)
    named = known.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "best")
    out = found.join(named, "anchor").withColumn("chosen", F.col("best")[F.col("positive")])
    return out.select(
        "anchor_id",
        F.nullif("chosen.vec_id", F.lit(FIRST_ID)).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.nullif("vec_id", F.lit(FIRST_ID)).alias("negative_id"),
        F.col("chosen.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
