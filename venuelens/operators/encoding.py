"""One-hot encodings of array and scalar columns (SC-7, SC-8, JN-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from venuelens.functions.arrays import indicator, value_counts_map


def one_hot_array(df: DataFrame, col: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """A count column per listed value of an array column, computed in place without moving rows.

    The counts of a row are formed once, as a map, and every column reads that. For values that are not known
    beforehand there is ``sparse_counts``, whose rows stay as narrow as their arrays.
    """
    counted = df.withColumn("_counts", value_counts_map(F.col(col)))
    columns = {f"{prefix or col}_{v}": F.coalesce(F.try_element_at("_counts", F.lit(v)), F.lit(0)).cast("int") for v in values}
    return counted.withColumns(columns).drop("_counts")


def one_hot_scalar(df: DataFrame, col: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """A 0/1 column per listed value; a missing or other value gives zeros only."""
    return df.withColumns({f"{prefix}{v}": indicator(F.col(col), v) for v in values})


def sparse_counts(df: DataFrame, col: str, name: str = "value_counts") -> DataFrame:
    """The same counts as a map per row, for any number of values."""
    return df.withColumn(name, value_counts_map(F.col(col)))
