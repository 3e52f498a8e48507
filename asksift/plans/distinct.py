"""Distinct texts with stable ids, as a stage table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.identity import assign_ids, distinct_texts
from ..sources.stages import shared_folder


def number_distinct(
    log: DataFrame, folder: str, text: str = "Query", ordinal: str = "ordinal"
) -> DataFrame:
    """One row per text: the text, its first ordinal, its log rows, its id. The
    distinct rows are sorted straight out of the one shuffle of the log and written
    below ``folder`` with their places, which the result reads."""
    return assign_ids(distinct_texts(log, text, ordinal), text=text, folder=folder)


def dedupe(
    log: DataFrame,
    folder: str | None = None,
    text: str = "Query",
    ordinal: str = "ordinal",
) -> DataFrame:
    """The same below a folder, so that nothing built on it comes back to the log. The
    sorted rows are the stage table; an id is its row's place and what comes before its
    partition, so nothing is written twice."""
    folder = folder or shared_folder(log.sparkSession)
    return number_distinct(log, folder, text, ordinal)
