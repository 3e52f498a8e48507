"""Agreement between raters: overall, per category, per pair, and kappa.

The raw agreement indices ask: if one rater picked at random rates a case, how
likely does another one rate it the same? With n_ij raters putting case i in
category j and K_i raters on case i,

    specific(j) = sum_i n_ij (n_ij - 1) / sum_i n_ij (K_i - 1)
    overall     = sum_ij n_ij (n_ij - 1) / sum_i K_i (K_i - 1)

Everything starts from ``rating_patterns``: cases with the same ratings are
counted together, which is one map-side combined pass over the cases and
leaves at most categories ** raters rows. All further sums run on that table,
in whole numbers with one division at the end, so partitioning cannot change
a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EXACT = "decimal(19,0)"


def to_binary(df: DataFrame, columns: list[str]) -> DataFrame:
    """YES / NO to 1 / 0; null stays null."""
    return df.withColumns({c: (F.col(c) == "YES").cast("int") for c in columns})


def any_of_raters(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """Derived rater: 1 when any of the given 0/1 raters says 1."""
    return df.withColumn(out, F.greatest(*columns))


def long_ratings(df: DataFrame, case: str, raters: list[str]) -> DataFrame:
    """Wide ratings to one row per case and rater."""
    return df.select(case, *raters).unpivot(case, raters, "rater", "rating")


def wide_ratings(long: DataFrame, case: str, raters: list[str]) -> DataFrame:
    return long.groupBy(case).pivot("rater", raters).agg(F.first("rating"))


def rating_patterns(df: DataFrame, raters: list[str]) -> DataFrame:
    """Number of cases per combination of ratings."""
    return df.groupBy(*raters).agg(F.count("*").alias("n_cases"))


def _ratio(part: Column, whole: Column) -> Column:
    """Null when there is nothing to divide by."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def _category_sums(patterns: DataFrame, rater_sets: dict[str, list[str]]) -> DataFrame:
    sets = F.array(
        *[
            F.struct(
                F.lit(name).alias("rater_set"),
                F.array_compact(F.array(*raters)).alias("ratings"),
            )
            for name, raters in rater_sets.items()
        ]
    )
    per_category = patterns.select("n_cases", F.inline(sets)).select(
        "n_cases",
        "rater_set",
        "ratings",
        F.explode(F.array_distinct("ratings")).alias("category"),
    )
    n_raters = F.size("ratings")
    n_same = n_raters - F.size(F.array_remove("ratings", F.col("category")))
    return (
        per_category.withColumns({"n": n_same.cast("long"), "k": n_raters.cast("long")})
        .groupBy("rater_set", "category")
        .agg(
            F.sum(F.col("n_cases") * F.col("n") * (F.col("n") - 1)).alias("agreeing"),
            F.sum(F.col("n_cases") * F.col("n") * (F.col("k") - 1)).alias("possible"),
        )
    )


def specific_agreement(
    patterns: DataFrame, rater_sets: dict[str, list[str]]
) -> DataFrame:
    """Agreement per rater set and category."""
    return _category_sums(patterns, rater_sets).select(
        "rater_set",
        "category",
        "agreeing",
        "possible",
        _ratio(F.col("agreeing"), F.col("possible")).alias("value"),
    )


def overall_agreement(
    patterns: DataFrame, rater_sets: dict[str, list[str]]
) -> DataFrame:
    """Agreement per rater set over all categories."""
    return (
        _category_sums(patterns, rater_sets)
        .groupBy("rater_set")
        .agg(F.sum("agreeing").alias("agreeing"), F.sum("possible").alias("possible"))
        .withColumn("value", _ratio(F.col("agreeing"), F.col("possible")))
    )


def _rater_pairs(
    patterns: DataFrame, raters: list[str], with_self: bool
) -> DataFrame:
    pairs = [
        F.struct(
            F.lit(a).alias("rater_i"),
            F.lit(b).alias("rater_j"),
            F.col(a).alias("rating_i"),
            F.col(b).alias("rating_j"),
        )
        for i, a in enumerate(raters)
        for b in raters[i if with_self else i + 1 :]
    ]
    return patterns.select("n_cases", F.inline(F.array(*pairs)))


def pair_agreement(patterns: DataFrame, raters: list[str]) -> DataFrame:
    """Share of equal ratings for every pair of raters, self pairs included.
    A case counts where both have rated it."""
    return agreement_of_pairs(_rater_pairs(patterns, raters, with_self=True))


def agreement_of_pairs(pairs: DataFrame) -> DataFrame:
    """The same from ``rater_i, rater_j, rating_i, rating_j, n_cases``."""
    both = F.col("rating_i").isNotNull() & F.col("rating_j").isNotNull()
    same = F.col("rating_i") == F.col("rating_j")
    zero = F.lit(0).cast("long")
    return (
        pairs.groupBy("rater_i", "rater_j")
        .agg(
            F.sum(F.when(same, F.col("n_cases")).otherwise(zero)).alias("n_same"),
            F.sum(F.when(both, F.col("n_cases")).otherwise(zero)).alias("n_both"),
        )
        .withColumn("value", _ratio(F.col("n_same"), F.col("n_both")))
    )


def pair_contingency(
    long: DataFrame, case: str, raters: list[str], complete: bool = False, with_self: bool = True
) -> DataFrame:
    """How many cases two raters put where: ``rater_i, rater_j, rating_i, rating_j,
    n_cases``, for every pair in the order of ``raters``.

    For many raters, where hardly two cases have the same ratings throughout: a
    case's ratings (one per rater; of several the greatest counts) meet in an array
    that is as long as there are raters, and its pairs are counted before they
    are shuffled, so what is shuffled then is raters^2 times categories^2 rows per
    task at most. Missing ratings make no pair; with ``complete``, only cases that
    all raters have rated count.
    """
    places = F.create_map(*[F.lit(x) for i, r in enumerate(raters) for x in (r, i)])
    rated = long.where(F.col("rating").isNotNull() & F.col("rater").isin(raters))
    one = rated.groupBy(case, "rater").agg(F.max("rating").alias("rating"))
    entry = F.struct(places[F.col("rater")].alias("place"), "rater", "rating")
    cases = one.groupBy(case).agg(F.array_sort(F.collect_list(entry)).alias("__ratings"))
    if complete:
        cases = cases.where(F.size("__ratings") == len(raters))
    ratings = F.col("__ratings")

    def with_later(x: Column, i: Column) -> Column:
        begin = i + (1 if with_self else 2)
        later = F.slice(ratings, begin, F.greatest(F.size(ratings) - begin + 1, F.lit(0)))
        return F.transform(
            later,
            lambda y: F.struct(
                x["rater"].alias("rater_i"), y["rater"].alias("rater_j"),
                x["rating"].alias("rating_i"), y["rating"].alias("rating_j"),
            ),
        )

    pairs = cases.select(F.inline(F.flatten(F.transform(ratings, with_later))))
    return pairs.groupBy(*pairs.columns).agg(F.count("*").alias("n_cases"))


def rater_label(rater: Column, names: dict[str, str]) -> Column:
    """Display name of a rater, its own name where none is given."""
    if not names:
        return rater
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[rater], rater)


def agreement_matrix_long(
    patterns: DataFrame, raters: list[str], names: dict[str, str] | None = None
) -> DataFrame:
    """Every cell of the square agreement matrix as a row, with display names
    and a two-digit label."""
    there = F.struct(F.col("rater_i").alias("a"), F.col("rater_j").alias("b"))
    back = F.struct(F.col("rater_j").alias("a"), F.col("rater_i").alias("b"))
    cells = F.when(F.col("rater_i") == F.col("rater_j"), F.array(there)).otherwise(
        F.array(there, back)
    )
    return (
        pair_agreement(patterns, raters)
        .select("value", F.inline(cells))
        .select(
            rater_label(F.col("a"), names or {}).alias("rater_i"),
            rater_label(F.col("b"), names or {}).alias("rater_j"),
            "value",
            F.round("value", 2).alias("value_label"),
        )
    )


def agreement_matrix(
    patterns: DataFrame, raters: list[str], names: dict[str, str] | None = None
) -> DataFrame:
    """The square matrix itself, one row and one column per rater."""
    columns = [(names or {}).get(r, r) for r in raters]
    return (
        agreement_matrix_long(patterns, raters, names)
        .groupBy("rater_i")
        .pivot("rater_j", columns)
        .agg(F.first("value"))
    )


def cohen_kappa(patterns: DataFrame, raters: list[str]) -> DataFrame:
    """Cohen's kappa of every pair, over the cases that all raters have rated."""
    complete = patterns.na.drop(subset=raters)
    return kappa_of_pairs(_rater_pairs(complete, raters, with_self=False))


def kappa_of_pairs(pairs: DataFrame) -> DataFrame:
    """Cohen's kappa per ``rater_i, rater_j`` from ``rating_i, rating_j, n_cases``.

    With N cases, D of them on the diagonal and E the sum over categories of
    row total times column total, kappa = (D N - E) / (N^2 - E); null when
    chance alone explains everything (N^2 = E).
    """
    n = F.col("n_cases")
    zero = F.lit(0).cast("long")
    same = F.col("rating_i") == F.col("rating_j")
    sides = F.array(
        F.struct(
            F.col("rating_i").alias("category"),
            n.alias("row"),
            zero.alias("col"),
            F.when(same, n).otherwise(zero).alias("diagonal"),
        ),
        F.struct(
            F.col("rating_j").alias("category"),
            zero.alias("row"),
            n.alias("col"),
            zero.alias("diagonal"),
        ),
    )
    margins = (
        pairs.select("rater_i", "rater_j", "n_cases", "rating_i", "rating_j")
        .select("rater_i", "rater_j", F.inline(sides))
        .groupBy("rater_i", "rater_j", "category")
        .agg(
            F.sum("row").cast(EXACT).alias("row"),
            F.sum("col").cast(EXACT).alias("col"),
            F.sum("diagonal").cast(EXACT).alias("diagonal"),
        )
    )
    totals = margins.groupBy("rater_i", "rater_j").agg(
        F.sum("row").cast(EXACT).alias("n"),
        F.sum("diagonal").cast(EXACT).alias("d"),
        F.sum(F.col("row") * F.col("col")).alias("e"),
    )
    above_chance = F.col("d") * F.col("n") - F.col("e")
    room = F.col("n") * F.col("n") - F.col("e")
    return totals.select(
        "rater_i",
        "rater_j",
        F.col("n").cast("long").alias("n_cases"),
        _ratio(above_chance, room).alias("kappa"),
    )


def light_kappa(patterns: DataFrame, raters: list[str]) -> DataFrame:
    """Mean of Cohen's kappa over all pairs; pairs without one are left out."""
    return cohen_kappa(patterns, raters).agg(
        F.count("*").alias("n_pairs"), F.avg("kappa").alias("kappa")
    )
