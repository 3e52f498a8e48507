"""Distinct texts, stable dense ids, keep-first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.stages import shared_folder, stage

def number_rows(
    df: DataFrame,
    out: str,
    order: list[Column],
    levels: list[Column],
    within: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``out`` = 1..N in the order of ``order``, without one global sort.

    ``levels`` are coarser and coarser keys that keep that order (every row of
    one bucket sorts before every row of the next). Each bucket is numbered on
    its own; what comes before it is a prefix sum over bucket counts, taken
    level by level so that no window sees more than one bucket's children.
    ``within`` numbers every group of these columns separately.
    """
    keys = [f"__level{i}" for i in range(len(levels))]
    tagged = df.withColumns(dict(zip(keys, levels)))

    counts = tagged.groupBy(*within, *keys).agg(F.count("*").alias("__n"))
    before = None
    for i, key in enumerate(keys):
        parents = [*within, *keys[i + 1 :]]
        earlier = Window.partitionBy(*parents).orderBy(key).rowsBetween(
            Window.unboundedPreceding, -1
        )
        shift = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
        step = counts.select(*within, *keys[i:], shift.alias(f"__before{i}"))
        before = step if before is None else before.join(step, [*within, *keys[i:]])
        counts = counts.groupBy(*parents).agg(F.sum("__n").alias("__n"))

    offset = sum((F.col(f"__before{i}") for i in range(1, len(keys))), F.col("__before0"))
    before = before.select(*within, keys[0], offset.alias("__offset"))
    inside = Window.partitionBy(*within, keys[0]).orderBy(*order)
    return (
        tagged.withColumn("__inside", F.row_number().over(inside))
        .join(before, [*within, keys[0]])
        .select(*df.columns, (F.col("__offset") + F.col("__inside")).alias(out))
    )


def number_sorted(df: DataFrame, out: str, order: list[Column], folder: str) -> DataFrame:
    """Add ``out`` = 1..N in a total order, through one distributed sort.

    The sorted rows are written once, each with its partition and its place in
    it (the upper and lower bits of Spark's increasing id). What comes before a
    partition is a running sum over one count per partition, a table that is as
    long as there are sort partitions. Rows of the written table never change
    their number, whatever is recomputed.
    """
    placed = df.sort(*order).withColumn("__place", F.monotonically_increasing_id())
    placed = stage(placed, f"{folder}/sorted")
    part = F.shiftright("__place", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    before = counts.select("__part", shift.alias("__before"))
    inside = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(before), "__part")
        .select(*df.columns, (F.col("__before") + inside + 1).alias(out))
    )


def distinct_texts(
    log: DataFrame, text: str = "Query", ordinal: str = "ordinal"
) -> DataFrame:
    """One row per text with its first ordinal and its number of log rows.

    The counts are combined before the shuffle, so a text that fills a third
    of the log costs one row per map task.
    """
    return log.groupBy(text).agg(
        F.min(ordinal).alias("first_ordinal"), F.count("*").alias("n_rows")
    )


def assign_ids(
    distinct: DataFrame, out: str = "UniqueID", text: str = "Query", folder: str | None = None
) -> DataFrame:
    """Number the distinct texts 1..N by first appearance.

    Texts that first appear at the same ordinal follow each other by text, and
    texts without an ordinal come last, so every text has a number and a retry
    gives the same one.
    """
    order = [F.col("first_ordinal").asc_nulls_last(), F.col(text)]
    return number_sorted(distinct, out, order, folder or shared_folder(distinct.sparkSession))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of every key in the given order.

    Spark prunes each map task to one row per key before the shuffle
    (WindowGroupLimit), so a hot key does not land on one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )
