"""Number parsing, the null model and target transforms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The texts a CSV reader of the original data treats as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Java's parser also takes "1d", "2f" and hex floats; those are not numbers here.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def na_to_null(c: Column) -> Column:
    """Text with the missing-value tokens turned into NULL."""
    return F.when(~c.isin(*NA_TOKENS), c)


def nan_to_null(c: Column) -> Column:
    """Spark keeps NULL and NaN apart; this library knows only NULL."""
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def decimal_comma(c: Column) -> Column:
    """``"4,5"`` to 4.5; unparsable text becomes NULL."""
    return to_number(F.replace(c.cast("string"), F.lit(","), F.lit(".")))


def digits_to_int(c: Column) -> Column:
    """All digits of a text joined into one integer; NULL when there are none."""
    return F.regexp_replace(c, "[^0-9]", "").try_cast("bigint")


def log_target(c: Column) -> Column:
    return F.log1p(c.cast("double"))


def unlog_target(c: Column) -> Column:
    """Back from the log scale, negative predictions clipped to zero."""
    return F.when(c.isNotNull(), F.greatest(F.expm1(c), F.lit(0.0)))
