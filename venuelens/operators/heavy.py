"""The most frequent values of a column with very many, without a shuffle of all values."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

#: Sizes of the summary that are tried, in values tracked. Each misses at most about 3.5 / size of all rows for any value.
TRACKED = (1 << 16, 1 << 18)


def candidates(df: DataFrame, col: str, k: int, tracked: int) -> tuple[list, int]:
    """At most k values that may be the most frequent ones, and a proven bound on the count of every other value.

    One pass with a mergeable summary of fixed size (Spark's ``approx_top_k``). A value it does not return either counts as little as the
    summary may miss, twice at most, or no more than the last returned one.
    """
    row = df.where(F.col(col).isNotNull()).agg(F.expr(f"approx_top_k(`{col}`, {k}, {tracked})").alias("top"), F.count(col).alias("n")).first()
    missed = 3.5 * row["n"] / tracked
    found = row["top"] or []
    least = found[-1]["count"] + missed if len(found) == k else 0
    return [r["item"] for r in found], math.floor(max(2 * missed, least))


def among(df: DataFrame, col: str, values: list) -> DataFrame:
    """The rows with one of the candidates; their number was given to ``candidates``, so they fit in every task."""
    kept = df.sparkSession.createDataFrame([(v,) for v in values], f"`{col}` {df.schema[col].dataType.simpleString()}")
    return df.join(F.broadcast(kept), col, "left_semi")


def top_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    """(value, row_count) of the k most frequent values, ties to the smaller value; NULL is no value.

    Candidates come from a summary; only they are counted, exactly. The result stands if the last count lies above the bound on all other
    values; otherwise a larger summary is tried, and at last all values are counted, as for a column without frequent ones.
    """
    def best(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), "value").limit(k)

    named = df.select(col).where(F.col(col).isNotNull())
    for tracked in TRACKED:
        values, bound = candidates(named, col, 4 * k, tracked)
        top = best(among(named, col, values))
        rows = top.collect()  # at most k
        if bound < 1 or (len(rows) == k and rows[-1]["row_count"] > bound):
            return df.sparkSession.createDataFrame(rows, top.schema)
    return best(named)
