"""Connected components of a graph given as a table of edges.

Tasks join the edges that they read into trees, and every node then meets its
labels of all tasks once: the smallest is its own, and the others are edges of a
much smaller graph, with which the same is done in as few tasks as hold it, until no
node has two labels.
The levels are put together at the end. Where that does not shrink the graph, as
with long paths, large-star and small-star steps alternate until the edges stop
changing; what is left is one star per component around its smallest node.

Every step is written to a stage table, so lost executors cost a read, and what is
no longer needed is dropped; whether edges are left is told while they are
written. A node or a component that a third of all edges touch is spread over
many join keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import counted_stage, drop_stages, shared_folder

SALTS = 16
MAX_ROUNDS = 60
#: Edges that a task joins at once.
TREE_EDGES = 1 << 19
#: Levels are added as long as each has at most so many of the edges before it.
SHRINK = 0.5


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], spread: str, salts: int = SALTS) -> DataFrame:
    """Inner join where a key may hold most rows of ``big``: its rows are dealt
    by the hash of ``spread`` and the one row of ``small`` is repeated."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt")
    left = big.withColumn("__salt", F.pmod(F.hash(spread), F.lit(salts)))
    right = small.select("*", salt)
    return left.join(right.hint("merge"), [*keys, "__salt"]).drop("__salt")


def salted_lookup(big: DataFrame, small: DataFrame, key: str, spread: str, value: str) -> DataFrame:
    """Left join in the same way, to the one row of ``small`` with the key, if any."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    left = big.withColumn("__salt", F.pmod(F.hash(spread), F.lit(SALTS)))
    right = small.select(key, value, salt)
    return left.join(right.hint("merge"), [key, "__salt"], "left").drop("__salt")


def trees(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    left, right = at[: len(a)], at[len(a) :]
    while len(a):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return nodes, nodes[label]


def _labelled(edges: DataFrame) -> DataFrame:
    """``node, label, others``: a node's smallest label and the other ones."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flushed() -> pa.RecordBatch:
            found = trees(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "label"])

        for batch in batches:
            for low in range(0, batch.num_rows, TREE_EDGES):
                part = batch.slice(low, TREE_EDGES)
                held.append(tuple(part.column(i).to_numpy() for i in (0, 1)))
                if sum(len(a) for a, _ in held) >= TREE_EDGES:
                    yield flushed()
        if held:
            yield flushed()

    labels = F.collect_set("label").alias("labels")
    met = edges.mapInArrow(join, "node long, label long").groupBy("node").agg(labels)
    least = F.array_min("labels")
    return met.select("node", least.alias("label"), F.array_remove("labels", least).alias("others"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return salted_join(both, least, ["a"], "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = salted_join(down, least, ["a"], "b").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b`` (longs);
    a component is named by its smallest node. Loops and repeats do no harm."""
    folder = shared_folder(edges.sparkSession)
    levels: list[DataFrame] = []
    now, before = edges.select("a", "b").where("a <> b"), None
    while True:
        path = f"{folder}/level-{len(levels)}"
        table, seen = counted_stage(_labelled(now), path, edges=F.sum(F.size("others")), nodes=F.count("*"))
        levels.append(table.select("node", F.col("label").alias("component")))
        if not seen["edges"]:
            break
        tasks = -(-max(seen["edges"], seen["nodes"]) // TREE_EDGES)
        now = table.select(F.explode("others").alias("a"), F.col("label").alias("b")).coalesce(tasks)
        if before is not None and seen["edges"] > SHRINK * before:
            levels.append(_by_stars(now, folder))
            break
        before = seen["edges"]
    out = levels[-1]
    for level in reversed(levels[:-1]):
        last = out.select(F.col("node").alias("component"), F.col("component").alias("further"))
        out = salted_lookup(level, last, "component", "node", "further")
        out = out.select("node", F.coalesce("further", "component").alias("component"))
    return out


def _by_stars(edges: DataFrame, folder: str) -> DataFrame:
    spark = edges.sparkSession
    sign = {"n": F.count("*"), "sum": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}
    path = f"{folder}/edges"
    now, seen = counted_stage(edges.distinct(), path, **sign)
    for number in range(MAX_ROUNDS):
        last, path = path, f"{folder}/round-{number}"
        now, found = counted_stage(_small_star(_large_star(now)).distinct(), path, **sign)
        drop_stages(spark, last)
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return members.unionByName(heads)
