"""Bounded samples of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

PARTS = 1 << 30


def hash_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows picked by the hash of their keys, and never more than
    twice as many; all rows of a table that has fewer.

    Every task keeps its share only, so what reaches the driver does not grow
    with the number of tasks. Counting reads no more than the keys.
    """
    share = min(1.0, rows / max(1, df.select(*keys).count()))
    picked = F.pmod(F.xxhash64(*keys), F.lit(PARTS)) < int(share * PARTS)
    return df.where(picked).limit(2 * rows) if share < 1 else df
