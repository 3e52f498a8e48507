"""Two-stage triage: a category and a reason for every eligible text, and a
structured question for those in the foreground."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.responses import (
    FOREGROUND,
    structured_question,
    triage_category,
    triage_reasoning,
)
from ..sources.stages import shared_folder
from .asking import ask_open
from .calls import Pool, as_answered
from .merging import NOT_AVAILABLE

CallFn = Callable[[str, str], str]

# Column prefixes of the wide triage table.
CATEGORY_COLUMN = "ARIA_Category_"
REASONING_COLUMN = "ARIA_Reasoning_"
QUESTION_COLUMN = "GRADE_Question_"

# Answered rows that a task hands on together.
ANSWERS_AT_A_TIME = 2000


@dataclass(frozen=True)
class Template:
    """A system message, and the line that introduces the text."""

    system: str
    lead: str


CLASSIFY = Template(
    "Sort the query into one category and say why.\n"
    "Category: [Unrelated | Background | Foreground]\n"
    "Reasoning: [short reason]\n",
    "Query to classify:",
)
REFORMULATE = Template(
    'Rewrite the query as "Should [Intervention] vs [Comparator] be used in '
    '[Population]?". Without a specific intervention answer exactly: '
    '"Error: Intervention too vague."\n',
    "Query to transform into a structured question:",
)


def user_message(template: Template, text: Column) -> Column:
    return F.concat(F.lit(template.lead + "\n"), text)


def render_triage_prompts(texts: DataFrame, template: Template) -> DataFrame:
    """Add the system and user message, and both in one for models that take
    a single prompt."""
    user = user_message(template, F.col("Query"))
    return texts.select(
        "*",
        F.lit(template.system).alias("system_prompt"),
        user.alias("user_prompt"),
        F.concat(F.lit(template.system + "\n\n"), user).alias("single_prompt"),
    )


def model_matrix(texts: DataFrame, models: list[str]) -> DataFrame:
    """Every text once per model."""
    names = F.array(*[F.lit(m) for m in models])
    return texts.select("*", F.explode(names).alias("model"))


def parse_triage(df: DataFrame, raw: str = "raw") -> DataFrame:
    return df.withColumns(
        {
            "category": triage_category(F.col(raw)),
            "reasoning": triage_reasoning(F.col(raw)),
        }
    )


def foreground(triaged: DataFrame) -> DataFrame:
    """The rows that go on to reformulation."""
    return triaged.where(F.col("category") == FOREGROUND)


def _ask(
    df: DataFrame, calls: dict[str, CallFn], template: Template, tasks: int | None, pool: Pool
) -> DataFrame:
    """Add the answer of each row's model, empty if the call failed, and its error."""
    lead, system = template.lead, template.system
    if tasks:
        df = df.repartition(tasks, "UniqueID", "model")

    place = {name: i for i, name in enumerate(df.columns)}
    text, model = place["Query"], place["model"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for frame in frames for row in frame.itertuples(index=False, name=None))
        asks = ((row, partial(calls[row[model]], system, f"{lead}\n{row[text]}")) for row in rows)
        done = ((*row, raw if error is None else "", error) for row, raw, error in as_answered(asks, pool))
        while some := list(islice(done, ANSWERS_AT_A_TIME)):
            yield pd.DataFrame(some, columns=[*place, "raw", "error"])

    fields = [f"`{name}` {kind}" for name, kind in df.dtypes]
    schema = ", ".join([*fields, "raw string", "error string"])
    return df.mapInPandas(run, schema)


def triage_with_calls(
    texts: DataFrame,
    calls: dict[str, CallFn],
    classify: Template = CLASSIFY,
    reformulate: Template = REFORMULATE,
    tasks: int | None = None,
    folder: str | None = None,
    pool: Pool = Pool(),
    waves: int = 1,
    rounds: int = 1,
) -> DataFrame:
    """Ask every model about every text, then once more for foreground texts.

    All answers are kept in tables below ``folder``; called again with the same
    folder, only what has no answer yet is asked. ``waves`` and ``rounds`` are those
    of ``ask_open``. Failed calls leave an empty answer and an error; the row stays.
    ``tasks`` sets how many tasks call at a time, ``pool`` how each of them does.
    """
    folder = folder or shared_folder(texts.sparkSession)
    keys = ["UniqueID", "model", "Query"]
    answered = F.col("error").isNull()

    def first(rows: DataFrame) -> DataFrame:
        return parse_triage(_ask(rows, calls, classify, tasks, pool)).drop("raw")

    def second(rows: DataFrame) -> DataFrame:
        asked = _ask(rows.select(*keys), calls, reformulate, tasks, pool)
        return asked.select(*keys, structured_question(F.col("raw")).alias("question"), "error")

    matrix = model_matrix(texts.select("UniqueID", "Query"), list(calls))
    classified = ask_open(matrix, keys, f"{folder}/classified", first, answered, waves, rounds)
    gathered = classified.groupBy("UniqueID", "Query").agg(_gathered("category").alias("first"))
    wanted = foreground(gathered.select("UniqueID", "Query", F.inline(_last_of_models(F.col("first")))))
    asked = ask_open(wanted.select(*keys), keys, f"{folder}/reformulated", second, answered, waves, rounds)
    return _both_answers(classified, asked)


def _gathered(*fields: str) -> Column:
    """Answers of a text, as an aggregate: a few rows, by models and rounds."""
    return F.collect_list(F.struct("model", "usable", "round", *fields))


def _last_of_models(answers: Column) -> Column:
    """Of each model its usable answer, or else that of the last round."""
    ordered = F.array_sort(answers)
    return F.filter(ordered, lambda a, i: ~F.get(ordered, i + 1)["model"].eqNullSafe(a["model"]))


def _both_answers(classified: DataFrame, asked: DataFrame) -> DataFrame:
    """Last answers of the first stage with those of the second, gathered per text in one
    shuffle by id, which the wide table by id takes over. A text's rows follow each other
    in the stored answers, so what they repeat is packed away in that shuffle."""
    texts = ["UniqueID", "Query"]
    first = F.struct("model", "usable", "round", "category", "reasoning", "error").alias("first")
    second = F.struct("model", "usable", "round", "question", "error").alias("second")
    both = classified.select(*texts, first).unionByName(asked.select(*texts, second), allowMissingColumns=True)
    lists = both.repartition("UniqueID").groupBy(*texts).agg(F.collect_list("first").alias("first"), F.collect_list("second").alias("second"))
    # A text without an id, or an id without a text, has no answer of the second stage.
    named = F.col("UniqueID").isNotNull() & F.col("Query").isNotNull()
    rows = lists.select(
        *texts,
        F.explode(_last_of_models(F.col("first"))).alias("answer"),
        F.when(named, _last_of_models(F.col("second"))).alias("second"),
    )
    again = F.get(F.filter("second", lambda a: a["model"] == F.col("answer.model")), F.lit(0))
    rows = rows.withColumn("again", again)
    return rows.select(
        *texts,
        "answer.model",
        "answer.category",
        "answer.reasoning",
        F.coalesce("again.question", F.lit("")).alias("question"),
        F.coalesce("answer.error", "again.error").alias("error"),
    )


def triage_with_responses(
    texts: DataFrame,
    models: list[str],
    classified: DataFrame,
    reformulated: DataFrame,
) -> DataFrame:
    """The same from stored responses ``(UniqueID, model, raw)`` of both stages.

    A missing response counts as an empty one. Answers of the second stage are
    used for foreground texts only; of several answers to one question the last
    in text order counts. Answers of both stages are parsed and gathered together,
    a row per text with columns per model, so texts and answers meet by id alone, no
    text is copied per model before that, and what is not read afterwards (reasons,
    questions) is not moved.
    """
    parsed = parse_triage(classified.select("UniqueID", "model", "raw"))
    nothing = F.lit(None).cast("string")
    first = parsed.select("UniqueID", "model", "category", "reasoning", nothing.alias("again"))
    second = reformulated.select("UniqueID", "model", nothing.alias("category"), nothing.alias("reasoning"), F.col("raw").alias("again"))
    given = {f"__{i}": F.col("model") == m for i, m in enumerate(models)}
    best = F.struct("category", "reasoning")
    answers = first.unionByName(second).groupBy("UniqueID").agg(
        F.collect_set("model").alias("answered"),
        *[F.max(F.when(its, F.col("category"))).alias(f"{n}_category") for n, its in given.items()],
        *[F.max(F.when(its & F.col("category").isNotNull(), best)).alias(f"{n}_best") for n, its in given.items()],
        *[F.max(F.when(its, F.col("again"))).alias(f"{n}_again") for n, its in given.items()],
    )
    joined = texts.select("UniqueID", "Query").join(answers, "UniqueID", "left")

    def of_model(field: str) -> Column:
        """The column of the row's model, if that has answered. (With a set among them, the
        aggregates are hashed; maxima of texts alone would sort all answers.)"""
        found = F.coalesce(*[F.when(its, F.col(f"{n}{field}")) for n, its in given.items()])
        return F.when(F.array_contains("answered", F.col("model")), found)

    category = F.coalesce(of_model("_category"), F.lit(""))
    return model_matrix(joined, models).select(
        "UniqueID",
        "Query",
        "model",
        category.alias("category"),
        F.coalesce(of_model("_best.reasoning"), F.lit("")).alias("reasoning"),
        structured_question(F.when(category == FOREGROUND, of_model("_again"))).alias("question"),
    )


def or_not_available(text: Column) -> Column:
    """Empty and null become ``N/A``."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NOT_AVAILABLE))


def widen_triage(triaged: DataFrame, models: list[str]) -> DataFrame:
    """One row per text with three columns per model; no voting.

    The fixed model list gives every column, with ``N/A`` where a model has no
    answer. Of several rows for one text and model the last in text order counts.
    """
    fields = ("category", "reasoning", "question")
    wide = triaged.groupBy("UniqueID").agg(
        F.first("Query").alias("Query"),
        F.collect_set("model").alias("answered"),
        *[F.max(F.when(F.col("model") == m, F.struct(*fields))).alias(f"__{i}") for i, m in enumerate(models)],
    )
    columns = []
    for i, model in enumerate(models):
        for prefix, field in zip((CATEGORY_COLUMN, REASONING_COLUMN, QUESTION_COLUMN), fields):
            answer = F.when(F.array_contains("answered", F.lit(model)), F.col(f"__{i}.{field}"))
            columns.append(or_not_available(answer).alias(prefix + model))
    return wide.select("UniqueID", "Query", *columns)
