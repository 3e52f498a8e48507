"""The agreement figures of one rating table, from one pass over its cases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.agreement import (
    agreement_matrix_long,
    light_kappa,
    overall_agreement,
    rating_patterns,
    specific_agreement,
)
from ..sources.stages import stage


@dataclass(frozen=True)
class AgreementStudy:
    overall: DataFrame
    specific: DataFrame
    matrix: DataFrame
    kappa: dict[str, DataFrame]


def agreement_study(
    ratings: DataFrame,
    rater_sets: dict[str, list[str]],
    folder: str,
    names: dict[str, str] | None = None,
) -> AgreementStudy:
    """Overall and per-category agreement and Light's kappa per rater set, and
    the pairwise matrix over all raters.

    The pattern counts are written once; every figure reads that small table.
    """
    raters = list(dict.fromkeys(r for members in rater_sets.values() for r in members))
    patterns = stage(rating_patterns(ratings, raters), f"{folder}/patterns")
    return AgreementStudy(
        overall_agreement(patterns, rater_sets),
        specific_agreement(patterns, rater_sets),
        agreement_matrix_long(patterns, raters, names),
        {name: light_kappa(patterns, members) for name, members in rater_sets.items()},
    )
