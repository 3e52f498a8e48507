"""Text normalisation as column expressions."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

# The 29 code points that count as blank, as a regex class and
# as the character list that btrim takes.
BLANK = r"[\t-\r\x1c-\x20\x85\p{Z}]"
BLANK_CHARS = (
    "\t\n\x0b\x0c\r"
    "\x1c\x1d\x1e\x1f\x20"
    "\x85\xa0"
    "\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ZERO_WIDTH_SPACE = "\u200b"

@F.arrow_udf(returnType=T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    other = pc.fill_null(pc.invert(pc.string_is_ascii(texts)), False)
    folded = [unicodedata.normalize("NFKC", t) for t in texts.filter(other).to_pylist()]
    return pc.replace_with_mask(texts, other, pa.array(folded, texts.type))


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Spark has no such function, so an Arrow UDF calls Python's
    for the texts that are not plain ASCII. (Arrow's own normaliser does not
    compose characters again, so it will not do.)"""
    return _nfkc(text)


def collapse_blanks(text: Column) -> Column:
    """Every run of blanks becomes one space, none at either end."""
    return F.trim(F.regexp_replace(text, BLANK + "+", " "))


def normalize_text(text: Column) -> Column:
    """Null to empty, NFKC, zero-width spaces out, blanks collapsed.

    A no-break space needs no step of its own: NFKC makes it a plain space.
    """
    filled = F.coalesce(text.cast("string"), F.lit(""))
    visible = F.replace(nfkc(filled), F.lit(ZERO_WIDTH_SPACE), F.lit(""))
    return collapse_blanks(visible)


def strip(text: Column) -> Column:
    """Blanks off both ends."""
    return F.btrim(text, F.lit(BLANK_CHARS))


def strip_lower(text: Column) -> Column:
    return F.lower(strip(text))


def strip_upper(text: Column) -> Column:
    return F.upper(strip(text))


def strip_quotes(text: Column) -> Column:
    """Blanks, then double quotes, then single quotes off both ends."""
    return F.btrim(F.btrim(strip(text), F.lit('"')), F.lit("'"))
