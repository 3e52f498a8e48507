"""Final tables and unreadable responses."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.labelling import dead_letters


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").options(sep=sep, header=True).csv(path)


def append_dead_letters(parsed: DataFrame, path: str) -> None:
    """Keep unreadable responses with their raw text for inspection."""
    dead_letters(parsed).write.mode("append").parquet(path)
