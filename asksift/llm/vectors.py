"""Vectors of whole numbers, as the exact operators on vectors use them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: No component may be larger, so that products and sums of squares stay exact.
LARGEST = 1 << 24
#: Stands for a missing id and comes before all others.
FIRST_ID = -(1 << 63)


def whole_vectors(df: DataFrame, vector: str, scale: int, out: str = "values") -> DataFrame:
    """Rows whose vector is there and has finite components only, and the vector
    times ``scale``, rounded down, as ``out``. A component beyond ``LARGEST`` is
    an error."""
    x = F.col(vector).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    scaled = F.transform(x, lambda v: F.floor(v * scale))
    checked = F.transform(
        scaled,
        lambda v: F.when(F.abs(v) <= LARGEST, v).otherwise(F.raise_error(F.lit(f"component beyond {LARGEST}")).cast("long")),
    )
    return df.where(F.col(vector).isNotNull() & ~odd).withColumn(out, checked.cast("array<int>"))


def squared_norm(values: str) -> Column:
    return F.aggregate(F.col(values), F.lit(0).cast("long"), lambda a, v: a + v.cast("long") * v)


def matrix_of(column: pa.ListArray, width: int) -> np.ndarray:
    """The rows of a list column, filled up with zeros to ``width``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(flat) == len(sizes) * width and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def known_ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers, the missing ones as the first."""
    return column.cast(pa.int64()).fill_null(FIRST_ID).to_numpy(zero_copy_only=False)
