"""Mixing sources to target weights by temperature.

A source's share of all tokens is raised to an exponent between 0 (all sources
alike) and 1 (as found) and the results are normalised to weights. The exponent
is bisected until the weights' entropy meets a target, and further up if a
source would be repeated more often than allowed. Weights times the budget give
every source its tokens, which are then drawn as budgeted block permutations:
a source is cut into blocks by hash; each pass over it (an epoch) visits its
blocks in a new order and the documents of a block in a new order; documents
are drawn as long as the tokens before them are within the budget.

A null source counts as the empty one, a null text has no tokens and is drawn
like any text without. A source without any tokens has no weight and is not
drawn. Repeated rows are drawn one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.stages import require_columns, shared_folder, stage

TOKEN = r"[^ \t\n\r\f]+"
#: Target entropy of the weights as a share of the highest possible one.
TARGET_ENTROPY = 0.95
#: No source is drawn more than so many times over.
MAX_REPEATS = 4.0
SEED = "mix"
#: A block has about so many tokens, unless its source would then have more
#: than so many blocks.
BLOCK_TOKENS = 1 << 16
MAX_BLOCKS = 4096
#: Halvings of the exponent's range, and how many of them one job looks ahead.
HALVINGS = 40
LOOKAHEAD = 5
EXPONENT_DIGITS = 9
#: Rows of one source are spread over so many join keys.
SALTS = 32


def count_tokens(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens`` per row; a token is a run of non-blanks."""
    require_columns(docs, "doc_id", "text", "source")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(TOKEN)).cast("long").alias("n_tokens"),
    )


def source_shares(counted: DataFrame) -> DataFrame:
    """Tokens of every source, and its share of all, for sources with tokens."""
    sources = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    total = sources.agg(F.sum("tokens").alias("total"))
    return sources.join(F.broadcast(total)).withColumn("share", F.col("tokens") / F.col("total"))


def _at_each(shares: DataFrame, exponents: list[float], *sums: Column) -> list:
    """Aggregates of the sources at each exponent ``a``, in the order of the exponents.

    The exponents are rows, so all looks ahead have the same short code: as columns,
    every job would have its own, with some sixty aggregates, for the driver to compile
    and keep."""
    points = F.posexplode(F.array(*[F.lit(float(a)) for a in exponents])).alias("k", "a")
    rows = shares.select("share", points).groupBy("k", "a").agg(*sums).collect()
    return sorted(rows, key=lambda row: row["k"])


def _entropies(shares: DataFrame, exponents: list[float]) -> list[float]:
    """The weights' entropy at each exponent."""
    power = F.pow("share", F.col("a"))
    rows = _at_each(shares, exponents, F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("l"))
    return [math.log(row["z"]) - row["a"] * row["l"] / row["z"] for row in rows]


def _repeats(shares: DataFrame, exponents: list[float], budget_share: float) -> list[float]:
    """How often the most repeated source is drawn at each exponent."""
    most = F.max(F.pow("share", F.col("a") - 1.0)).alias("m")
    rows = _at_each(shares, exponents, F.sum(F.pow("share", F.col("a"))).alias("z"), most)
    return [budget_share * row["m"] / row["z"] for row in rows]


def bisect_exponent(measure, target: float) -> float:
    """The least exponent in [0, 1] at which a falling measure is at most the
    target, to ``HALVINGS`` halvings; 1 if there is none.

    ``measure`` maps exponents to values in one job. Each job evaluates all
    midpoints that the next few halvings can ask for.
    """
    if measure([0.0])[0] <= target:
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(HALVINGS // LOOKAHEAD):
        steps = 1 << LOOKAHEAD
        points = [low + (high - low) * k / steps for k in range(1, steps)]
        values = measure(points)
        left, right = 0, steps
        for _ in range(LOOKAHEAD):
            middle = (left + right) // 2
            if values[middle - 1] <= target:
                right = middle
            else:
                left = middle
        low, high = low + (high - low) * left / steps, low + (high - low) * right / steps
    return round(high, EXPONENT_DIGITS)


def find_exponent(
    shares: DataFrame,
    target_entropy: float | None = TARGET_ENTROPY,
    max_repeats: float | None = MAX_REPEATS,
    budget_share: float = 1.0,
) -> float:
    """The exponent that meets the entropy target (a share of the logarithm of
    the number of sources), raised where the repetition limit needs it."""
    if max_repeats is not None and budget_share > max_repeats:
        raise ValueError("the budget alone repeats every source more often than allowed")
    sources = shares.count()
    exponent = 0.0
    if target_entropy is not None and sources > 1:
        target = target_entropy * math.log(sources)
        exponent = bisect_exponent(lambda a: _entropies(shares, a), target)
    if max_repeats is not None and sources:
        least = bisect_exponent(lambda a: _repeats(shares, a, budget_share), max_repeats)
        exponent = max(exponent, least)
    return exponent


def plan_budgets(shares: DataFrame, exponent: float, budget_share: float = 1.0) -> DataFrame:
    """Weight, tokens to draw and number of blocks per source."""
    power = F.pow("share", F.lit(exponent))
    total = shares.agg(F.sum(power).alias("z"))
    blocks = F.least(F.ceil(F.col("tokens") / F.lit(BLOCK_TOKENS)), F.lit(MAX_BLOCKS))
    return shares.join(F.broadcast(total)).select(
        "source",
        "tokens",
        (power / F.col("z")).alias("weight"),
        F.round(power / F.col("z") * F.col("total") * F.lit(budget_share)).cast("long").alias("budget"),
        blocks.cast("long").alias("blocks"),
    )


def hashed(*parts: Column | str) -> Column:
    """A 48-bit number from the md5 of the joined parts."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 12), 16, 10).cast("long")


def draw(counted: DataFrame, budgets: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per drawn document: ``doc_id, source, n_tokens, epoch, block,
    start`` (tokens of the source drawn before) and ``at``, its place in the
    mixed stream between 0 and 1; ordering by ``at`` keeps the weights all along.

    A source's rows meet only in blocks. Its list of blocks is bounded, and so
    are its epochs, by the repetition limit.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = budgets.select("source", "tokens", "budget", "blocks", salts.alias("salt"))
    docs = counted.withColumn("salt", F.pmod(F.hash("doc_id", "n_tokens"), F.lit(SALTS)))
    placed = docs.join(salted, ["source", "salt"]).withColumn(
        "block", F.pmod(hashed(F.lit(seed), F.lit("block"), F.col("doc_id")), F.col("blocks"))
    )
    epochs = F.when(
        F.col("budget") > 0,
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("budget") - 1) / F.col("tokens"))),
    )
    before = (Window.unboundedPreceding, -1)
    in_source = Window.partitionBy("source", "epoch").orderBy("turn", "block").rowsBetween(*before)
    none = F.lit(0).cast("long")
    starts = (
        placed.groupBy("source", "block", "tokens", "budget")
        .agg(F.sum("n_tokens").alias("block_tokens"))
        .withColumn("epoch", F.explode(epochs))
        .withColumn("turn", hashed(F.lit(seed), F.col("epoch"), F.col("source"), F.col("block")))
        .select(
            "source", "epoch", "block",
            F.coalesce(F.sum("block_tokens").over(in_source), none).alias("block_start"),
        )
    )
    in_block = (
        Window.partitionBy("source", "epoch", "block")
        .orderBy("turn", "doc_id", "n_tokens")
        .rowsBetween(*before)
    )
    drawn = (
        placed.withColumn("epoch", F.explode(epochs))
        .withColumn("turn", hashed(F.lit(seed), F.col("epoch"), F.col("doc_id")))
        .withColumn("ahead", F.coalesce(F.sum("n_tokens").over(in_block), none))
        .join(starts, ["source", "epoch", "block"])
        .withColumn("start", F.col("epoch") * F.col("tokens") + F.col("block_start") + F.col("ahead"))
        .where(F.col("start") < F.col("budget"))
    )
    return drawn.select(
        "doc_id", "source", "n_tokens", "epoch", "block", "start",
        (F.col("start") / F.col("budget")).alias("at"),
    )


def mix_sources(
    docs: DataFrame,
    target_entropy: float | None = TARGET_ENTROPY,
    max_repeats: float | None = MAX_REPEATS,
    budget_share: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """Draw a mixture of ``budget_share`` times all tokens; see ``draw``. Texts
    are read once, for their token counts."""
    folder = shared_folder(docs.sparkSession)
    counted = stage(count_tokens(docs), f"{folder}/counted")
    shares = stage(source_shares(counted), f"{folder}/shares")
    exponent = find_exponent(shares, target_entropy, max_repeats, budget_share)
    return draw(counted, plan_budgets(shares, exponent, budget_share), seed)
