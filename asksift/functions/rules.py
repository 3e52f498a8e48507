"""Multilingual rules that tell whether a text asks a question.

One native expression; no Python worker. A word is a maximal run of letters,
digits and underscores in any script, and the boundaries are spelled out
because the engine's own ``\\b`` does not see every script that way.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .text import strip_lower

# Interrogative words by language.
KEYWORDS = {
    "en": [
        "what", "when", "where", "why", "how", "who", "whom", "which",
        "do", "did", "does", "are", "is", "can", "could", "should", "would",
    ],
    "fr": [
        "quoi", "quand", "où", "pourquoi", "comment", "qui", "lequel",
        "est-ce", "peux-tu", "pourrais-tu",
    ],
    "es": [
        "qué", "cuándo", "dónde", "por qué", "cómo", "quién", "cuál",
        "puedes", "podrías",
    ],
    "de": [
        "was", "wann", "wo", "warum", "wie", "wer", "welche", "kann", "könnte",
    ],
    "nl": [
        "wat", "wanneer", "waar", "waarom", "hoe", "wie", "welke", "kan", "zou",
    ],
    "ru": [
        "что", "когда", "где", "почему", "как", "кто", "который", "может",
        "могли бы",
    ],
    "ar": ["ماذا", "متى", "أين", "لماذا", "كيف", "من", "هل", "أيمكن"],
    "fa": ["چه", "کی", "کجا", "چرا", "چطور", "کیست", "آیا"],
    "tr": [
        "ne", "ne zaman", "nerede", "neden", "nasıl", "kim", "hangi",
        "mı", "mi", "mu", "mü",
    ],
}
# Openings that invert verb and subject (English), the Turkish
# particle before a closing mark, markers within the first clause (French,
# Arabic, Persian), and phrases that ask without a question form.
INVERTED_MODALS = ["can", "could", "should", "would", "do", "did", "does"]
INVERTED_BE = ["is", "are", "was", "were", "am"]
TURKISH_PARTICLES = ["mı", "mi", "mu", "mü"]
CLAUSE_MARKERS = ["est-ce que", "هل", "آیا"]
REQUEST_PHRASES = [
    "could you", "would you", "can you", "please explain", "i wonder if",
    "i would like to know",
]

_NO_WORD = r"[^\p{L}\p{N}_]+"
_WORD_STARTS = r"(?<![\p{L}\p{N}_])"
_WORD_ENDS = r"(?![\p{L}\p{N}_])"


def _any_of(words: list[str]) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def _either(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def asks_by_mark(s: Column) -> Column:
    """Ends with a question mark."""
    return s.endswith("?")


def asks_by_structure(s: Column) -> Column:
    """Opens like a question, or has a question particle or marker in place.

    The plain string tests in front keep the regexes off most texts.
    """
    openings = INVERTED_MODALS + INVERTED_BE
    opened = _either(s.startswith(w) for w in openings) & s.rlike(
        "^" + _any_of(openings) + _WORD_ENDS
    )
    turkish = s.endswith("?") & s.rlike(
        _WORD_STARTS + _any_of(TURKISH_PARTICLES) + r"\?\z"
    )
    marked = _either(s.contains(m) for m in CLAUSE_MARKERS) & s.rlike(
        "^[^.!?]*" + _WORD_STARTS + _any_of(CLAUSE_MARKERS) + _WORD_ENDS
    )
    return asks_by_mark(s) | opened | turkish | marked


def asks_by_keyword(s: Column) -> Column:
    """Has an interrogative word as a whole word.

    One-word keywords are looked up among the words of the text; those with a
    space or hyphen are searched for.
    """
    keywords = list(dict.fromkeys(w for ws in KEYWORDS.values() for w in ws))
    single = [w for w in keywords if " " not in w and "-" not in w]
    longer = [w for w in keywords if w not in single]
    words = F.split(s, _NO_WORD)
    return F.exists(words, lambda word: word.isin(single)) | _either(
        s.contains(w) & s.rlike(_WORD_STARTS + re.escape(w) + _WORD_ENDS)
        for w in longer
    )


def asks_by_request(s: Column) -> Column:
    """Has a phrase that asks for something.

    Open on the left on purpose: a phrase may start inside a longer word.
    """
    return _either(s.contains(p) for p in REQUEST_PHRASES) & s.rlike(
        _any_of(REQUEST_PHRASES) + _WORD_ENDS
    )


# The rules by name, in the order in which they are reported.
RULES = {
    "punctuation": asks_by_mark,
    "structure": asks_by_structure,
    "keyword": asks_by_keyword,
    "request": asks_by_request,
}


def is_question_clean(s: Column) -> Column:
    """True when any rule holds for an already trimmed, lower-case text."""
    found = _either(rule(s) for rule in RULES.values())
    return F.coalesce(found, F.lit(False))


def is_question(text: Column) -> Column:
    """True when any rule holds; null and empty texts are no question."""
    return is_question_clean(strip_lower(text))


def fired_rule(text: Column) -> Column:
    """Name of the first rule that holds, null when none does."""
    s = strip_lower(text)
    return F.coalesce(*[F.when(rule(s), name) for name, rule in RULES.items()])


def yes_no(condition: Column) -> Column:
    return F.when(condition, "YES").otherwise("NO")


def label_by_rules(df: DataFrame, text: str = "Query") -> DataFrame:
    """Add ``Rules``: YES or NO for every row."""
    clean = df.withColumn("__clean", strip_lower(F.col(text)))
    label = yes_no(is_question_clean(F.col("__clean")))
    return clean.withColumn("Rules", label).drop("__clean")

