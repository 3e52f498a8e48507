"""Which texts go on to triage: any rater said YES."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .batching import RUN_PREFIX


def columns_with_prefix(df: DataFrame, prefix: str = RUN_PREFIX) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def any_yes(columns: list[str]) -> Column:
    """True when one of the columns says YES; null is not YES, and no column
    at all is false."""
    return reduce(or_, (F.col(c).eqNullSafe("YES") for c in columns), F.lit(False))


def is_eligible(
    df: DataFrame, rules: str = "Rules", prefix: str = RUN_PREFIX
) -> Column:
    """Rules or any run said YES. The rule column may be absent."""
    by_rules = F.col(rules).eqNullSafe("YES") if rules in df.columns else F.lit(False)
    return by_rules | any_yes(columns_with_prefix(df, prefix))


def eligible(df: DataFrame, rules: str = "Rules", prefix: str = RUN_PREFIX) -> DataFrame:
    return df.where(is_eligible(df, rules, prefix))


def eligible_from_long(distinct: DataFrame, labels: DataFrame) -> DataFrame:
    """The same from long labels, as a semi join."""
    yes = labels.where(F.col("label") == "YES").select("UniqueID")
    return distinct.join(yes, "UniqueID", "left_semi")
