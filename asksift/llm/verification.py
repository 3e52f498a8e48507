"""Exact Jaccard similarity inside groups of candidates.

Members of a group are dealt into blocks of bounded bytes, and each pair of
blocks is compared in a task of its own, so a group of any size is handled
whole. Links are counted and joined into local components there; no pair is
ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import salted_join

#: A block holds about so many members, or so many bytes of sets.
BLOCK_MEMBERS = 512
BLOCK_BYTES = 6 << 20
COLUMNS = 4096
LINKS_SCHEMA = "id long, links long, linked_weight long, head long"


def groups_in_order(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal integer keys in sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        first = tuple(c[0] for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sorted distinct sets."""
    if len(left) * len(right) <= 16:
        return np.array(
            [[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left]
        ).reshape(len(left), len(right))
    values_l, values_r = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(values_l, values_r)
    out = np.zeros((len(left), len(right)), np.float32)

    def cells(values: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, values), max(0, len(shared) - 1))
        keep = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        order = np.argsort(at[keep], kind="stable")
        return at[keep][order], owner[keep][order]

    (col_l, row_l), (col_r, row_r) = cells(values_l, left), cells(values_r, right)
    for low in range(0, len(shared), COLUMNS):
        high = min(low + COLUMNS, len(shared))
        parts = []
        for col, row, n in ((col_l, row_l, len(left)), (col_r, row_r, len(right))):
            a, b = np.searchsorted(col, [low, high])
            dense = np.zeros((n, high - low), np.float32)
            dense[row[a:b], col[a:b] - low] = 1
            parts.append(dense)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def similar(left: list[np.ndarray], right: list[np.ndarray], tenths: int) -> np.ndarray:
    """Which pairs have a Jaccard similarity of at least ``tenths`` tenths; two
    empty sets are alike."""
    both = intersections(left, right)
    sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return 10 * both >= tenths * (sizes - both)


def local_components(adjacent: np.ndarray) -> np.ndarray:
    """The smallest position in the component of each row of a square matrix."""
    label = np.arange(len(adjacent))
    while True:
        low = np.where(adjacent, label[None, :], len(label)).min(1, initial=len(label))
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def link_members(members: DataFrame, tenths: int = 8) -> DataFrame:
    """Compare all members of each group: ``group long, id long, weight long,
    tokens binary`` (sorted 64-bit hashes). Returns per id and pair of blocks
    the number of linked ids, their weight, and the smallest id linked there;
    ``sum`` them by id, and take (id, head) as edges."""
    sizes = members.groupBy("group").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("tokens")).alias("bytes")
    )
    blocks = F.greatest(
        F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("bytes") / BLOCK_BYTES)
    ).cast("int")
    several = sizes.where("n > 1").select("group", blocks.alias("blocks"))
    placed = salted_join(members, several, ["group"], "id").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = placed.withColumn("other", other).select(
        "group",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).alias("right"),
        "id", "weight", "tokens",
    )

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for table in groups_in_order(batches, ["group", "low", "high"]):
            ids = table.column("id").to_numpy()
            weights = table.column("weight").to_numpy()
            sets = [np.frombuffer(t.as_py(), np.uint64) for t in table.column("tokens")]
            order = np.argsort(ids)
            ids, weights = ids[order], weights[order]
            if table.column("low")[0].as_py() == table.column("high")[0].as_py():
                sets = [sets[i] for i in order]
                near = similar(sets, sets, tenths)
                np.fill_diagonal(near, False)
            else:
                right = table.column("right").to_numpy()[order]
                a, b = np.flatnonzero(~right), np.flatnonzero(right)
                near = np.zeros((len(ids), len(ids)), bool)
                if len(a) and len(b):
                    cross = similar([sets[order[i]] for i in a], [sets[order[i]] for i in b], tenths)
                    near[np.ix_(a, b)] = cross
                    near[np.ix_(b, a)] = cross.T
            linked = np.flatnonzero(near.any(1))
            if not len(linked):
                continue
            head = local_components(near)
            counts, weight = near[linked].sum(1), near[linked] @ weights
            out.append((ids[linked], counts, weight, ids[head[linked]]))
            rows += len(linked)
            if rows > 20_000:
                yield _links_batch(out)
                out, rows = [], 0
        if out:
            yield _links_batch(out)

    spread = paired.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")
    return spread.mapInArrow(links, LINKS_SCHEMA)


def _links_batch(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays(columns, ["id", "links", "linked_weight", "head"])
