"""Multi-valued categories: explode, rating statistics, popularity (SC-3, ST-8 to ST-11, TK)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def explode_values(df: DataFrame, col: str) -> DataFrame:
    """One row per array element; an empty or NULL array keeps its row with NULL."""
    return df.withColumn(col, F.explode_outer(col))


def category_stats(df: DataFrame, category: str, value: str) -> DataFrame:
    """Mean, non-NULL count and sample deviation of a value per category."""
    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(category)
        .agg(
            F.avg(value).alias("mean"),
            F.count(value).alias("count"),
            F.stddev_samp(value).alias("std"),
        )
    )


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean per key combination; rows with a NULL key are left out."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.avg(value).alias(name))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("value_count"))


def top_k(df: DataFrame, by: Column, ties: Sequence[Column | str], k: int) -> DataFrame:
    """The k rows with the highest value; ``ties`` must make the order unique."""
    return df.orderBy(by.desc_nulls_last(), *ties).limit(k)


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    return value_counts(df, col).orderBy(F.desc("value_count"), col).limit(k)


def rarest_values(df: DataFrame, col: str, k: int) -> DataFrame:
    return value_counts(df, col).orderBy(F.asc("value_count"), col).limit(k)
