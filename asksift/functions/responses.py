"""Parsers for what labelling models send back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .text import BLANK, strip, strip_quotes, strip_upper

# Keys of a label item and the label of an item without one.
TEXT_KEY = "query"
LABEL_KEY = "explicit_question"
DEFAULT_LABEL = "NO"

# Triage categories in order of precedence, and the answer that
# stands for "no structured question possible".
CATEGORIES = ["Foreground", "Background", "Unrelated"]
FOREGROUND = "Foreground"
TOO_VAGUE = "Error: Intervention too vague."

def json_array_text(raw: Column) -> Column:
    """From the first ``[`` to the last ``]``, null when there is none.

    Code fences and prose around the array fall away with it.
    """
    return F.nullif(F.regexp_extract(raw, r"(?s)\[.*\]", 0), F.lit(""))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _label_item(item: Column) -> Column:
    """A JSON value as (query, explicit_question)."""

    def field(fields: Column, name: str, default: str, tidy: Callable[[Column], Column]) -> Column:
        def of(value: Column) -> Column:
            is_text = F.schema_of_variant(value) == "STRING"
            said = F.try_variant_get(value, "$", "string")
            return F.when(value.isNull(), F.lit(default)).when(is_text, tidy(said))

        return F.when(fields.isNotNull(), _once(fields[name], of)).alias(name)

    def of_object(fields: Column) -> Column:
        return F.struct(
            field(fields, TEXT_KEY, "", strip), field(fields, LABEL_KEY, DEFAULT_LABEL, strip_upper)
        )

    return _once(F.try_variant_get(item, "$", "map<string,variant>"), of_object)


def _any_labels(text: Column) -> Column:
    """The items of any JSON array. Spark's JSON readers stop at the end of the first
    value and accept text behind it; so the array is read inside brackets, where it has
    to be the only value, and inside an object: what could end the one early is an error
    in the other."""
    inside = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}")))
    values = F.try_variant_get(inside, "$", "array<variant>")
    alone = (F.size(values) == 1) & named.isNotNull()
    items = F.when(alone, F.try_variant_get(values[0], "$", "array<variant>"))
    return F.transform(items, _label_item)


def _tidy_item(item: Column) -> Column:
    """The same for an item that was read by its schema."""

    def field(name: str, default: str, tidy: Callable[[Column], Column]) -> Column:
        return F.when(item.isNotNull(), F.coalesce(tidy(item[name]), F.lit(default))).alias(name)

    return F.struct(field(TEXT_KEY, "", strip), field(LABEL_KEY, DEFAULT_LABEL, strip_upper))


def parse_labels(raw: Column) -> Column:
    """Response text to an array of (query, explicit_question).

    Null when the text holds no well-formed JSON array. An item that is no object, or
    whose label is no string, keeps its place with a null label. A key that comes twice
    in an item, or a number that is none in JSON (NaN), makes the whole text unreadable.

    A text in the form that was asked for is read by its schema, several times faster:
    written as JSON again, what was read is the whole text, but for blanks. So nothing
    stood there that the schema leaves out, turns to text or does not get to. Every other
    text is read value by value (``_any_labels``).
    """
    schema = f"array<struct<{TEXT_KEY}:string,{LABEL_KEY}:string>>"

    def bare(text: Column) -> Column:
        return F.translate(text, " \t\r\n", "")

    def read(found: Column) -> Column:
        text, items, again = found["text"], found["items"], found["again"]
        as_asked = (again == text) | (bare(again) == bare(text))
        return F.when(as_asked, F.transform(items, _tidy_item)).otherwise(_any_labels(text))

    def written(found: Column) -> Column:
        again = F.to_json(found["items"], {"ignoreNullFields": "true"})
        return _once(F.struct(found["text"], found["items"], again.alias("again")), read)

    def by_schema(text: Column) -> Column:
        return _once(F.struct(text.alias("text"), F.from_json(text, schema).alias("items")), written)

    return _once(json_array_text(raw), by_schema)


def triage_category(raw: Column) -> Column:
    """Rest of the line after ``Category:``, as one of the known names when it
    contains one, else as it stands; empty when absent."""
    found = strip(
        F.regexp_extract(strip_quotes(raw), rf"(?iud)Category:{BLANK}*(.+)", 1)
    )
    low = F.lower(found)
    chain = F.when(low.contains(CATEGORIES[0].lower()), CATEGORIES[0])
    for name in CATEGORIES[1:]:
        chain = chain.when(low.contains(name.lower()), name)
    return F.coalesce(chain.otherwise(found), F.lit(""))


def triage_reasoning(raw: Column) -> Column:
    """Everything after ``Reasoning:``; empty when absent."""
    found = F.regexp_extract(strip_quotes(raw), rf"(?ius)Reasoning:{BLANK}*(.+)", 1)
    return F.coalesce(strip(found), F.lit(""))


def structured_question(raw: Column) -> Column:
    """Blanks and outer quotes off the reformulated question."""
    return F.coalesce(strip_quotes(raw), F.lit(""))


def is_too_vague(question: Column) -> Column:
    return question == F.lit(TOO_VAGUE)
