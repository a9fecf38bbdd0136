"""Text measures and keyword features, all Unicode aware (``(?U)``)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Word lists of the review features.
FIT_WORDS = ("fit", "fits", "fitting", "size", "small", "large", "tight", "loose", "petite", "waist", "hips")
QUALITY_WORDS = ("quality", "fabric", "material", "cheap", "expensive", "comfortable", "uncomfortable")
SIZE_WORDS = ("size", "small", "large", "tight", "loose", "petite", "waist", "hips")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Remove white space at both ends; ``trim`` alone removes only U+0020."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def char_count(c: Column) -> Column:
    return F.char_length(c).cast("bigint")


def word_count(c: Column) -> Column:
    """Number of runs of non-white-space."""
    return F.regexp_count(c, F.lit(r"(?U)\S+")).cast("bigint")


def has_text(c: Column) -> Column:
    return text_or_empty(c).rlike(r"(?U)\S").cast("int")


def combined_text(title: Column, body: Column) -> Column:
    return strip(F.concat(strip(text_or_empty(title)), F.lit(" "), strip(text_or_empty(body))))


def words_pattern(words: Sequence[str]) -> str:
    if not words:
        raise ValueError("keyword list is empty")
    return r"(?U)\b(" + "|".join(re.escape(w) for w in words) + r")\b"


def keyword_count(c: Column, words: Sequence[str]) -> Column:
    """Whole-word hits of any keyword, ignoring case; NULL text counts 0."""
    hits = F.regexp_count(F.lower(c), F.lit(words_pattern(words)))
    return F.coalesce(hits, F.lit(0)).cast("bigint")


def keyword_flag(c: Column, words: Sequence[str]) -> Column:
    return F.coalesce(F.lower(c).rlike(words_pattern(words)), F.lit(False)).cast("int")


def squeeze_name(c: Column) -> Column:
    """Trim, one blank between words, lower case."""
    return F.lower(F.regexp_replace(strip(c), r"(?U)\s+", " "))


def bare_name(c: Column) -> Column:
    """Lower-case letters a-z and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def tokens(c: Column) -> Column:
    """Lower-case tokens of at least two word characters."""
    return F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
