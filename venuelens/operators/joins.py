"""Anti-joins of large rows with a lookup of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def without_listed(rows: DataFrame, listed: DataFrame, col: str) -> DataFrame:
    """Rows whose value is not in ``listed``; rows without a value stay.

    Adaptive execution broadcasts the lookup if its measured bytes allow it and splits hot values otherwise.
    Rows without a value never match, so they are kept out of the join and of its hot partition.
    """
    named = rows.filter(F.col(col).isNotNull()).join(listed, [col], "left_anti")
    return named.unionByName(rows.filter(F.col(col).isNull()))
