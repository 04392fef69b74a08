"""Text expressions: product-name cleaning, first word, substring match.

Cleaning order matters and is fixed: lower-case -> delete digit runs -> delete
everything that is not ``a-z`` or whitespace (accents are deleted, hyphens fuse
words) -> delete whole-word stopwords -> squeeze whitespace -> trim.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the workload's cleaning rule: the twelve
# product-name stopwords (in their original order) and the four patterns.
NAME_STOPWORDS = ("with", "and", "in", "of", "the", "for", "a", "an", "free", "mix", "original", "pack")
DIGIT_RUNS = r"\d+"
NOT_LETTER_OR_SPACE = r"[^a-z\s]"
WHITESPACE_RUNS = r"\s+"


def stopword_pattern(words: Sequence[str] = NAME_STOPWORDS) -> str:
    """Whole-word alternation for ``words``."""
    return r"\b(?:" + "|".join(words) + r")\b"


NAME_STOPWORD_PATTERN = stopword_pattern()


def clean_text(col: Column | str, stopwords: Sequence[str] = NAME_STOPWORDS) -> Column:
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    c = F.regexp_replace(c, DIGIT_RUNS, "")
    c = F.regexp_replace(c, NOT_LETTER_OR_SPACE, "")
    if stopwords:
        c = F.regexp_replace(c, stopword_pattern(stopwords), "")
    c = F.regexp_replace(c, WHITESPACE_RUNS, " ")
    return F.trim(c)


def first_word(col: Column | str) -> Column:
    """First whitespace-separated word; NULL for NULL, empty or blank text
    (where a plain ``split()[0]`` would fail)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.regexp_extract(c, r"^\s*(\S+)", 1), F.lit(""))


def contains_ci(col: Column | str, needle: str) -> Column:
    """Case-insensitive substring test."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(c).contains(needle.lower())


def trailing_number(col: Column | str) -> Column:
    """Integer formed by the trailing digits of a code such as ``Brand#17``;
    NULL when there are none."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract(c, r"(\d+)$", 1).try_cast("int")
