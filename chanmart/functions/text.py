"""Text helpers for the search and most-mentioned-term reports."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words never counted as a product mention.
STOP_WORDS = ("and", "the", "for", "with", "http", "https", "t.me")
# Fixed value: a word must be longer than this many characters to count.
MIN_WORD_CHARS = 3
# Fixed value: tokens are separated by runs of whitespace.
WORD_SPLIT = r"\s+"


def words(text: Column) -> Column:
    """Lower-cased whitespace tokens of ``text`` as an array (NULL for NULL)."""
    return F.split(F.lower(text), WORD_SPLIT)


def is_product_word(word: Column) -> Column:
    return (F.length(word) > MIN_WORD_CHARS) & ~word.isin(*STOP_WORDS)


def ilike_pattern(query: str) -> str:
    """The ILIKE pattern ``%query%`` as Spark takes it.

    ``%`` and ``_`` in the query stay wildcards and ``\\`` escapes.  A backslash
    before any other character stands for that character alone; Spark's
    pattern refuses one there, so it is dropped.
    """
    query = re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], query, flags=re.DOTALL)
    return f"%{query}%"


def contains_ci(text: Column, query: str) -> Column:
    """Case-insensitive substring match with ILIKE semantics (see ``ilike_pattern``)."""
    return text.ilike(ilike_pattern(query))


def char_length(text: Column) -> Column:
    return F.length(text).cast("int")
