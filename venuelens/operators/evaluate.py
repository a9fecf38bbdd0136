"""Regression and ranking metrics (MD-11 to MD-14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from venuelens.operators.ranking import RANK_COLUMNS, add_positions, decile_size, top_decile


def _by(df: DataFrame, groups: Sequence[str]):
    return df.groupBy(*groups) if groups else df


def _errors(actual: str, predicted: str, suffix: str = "") -> list[Column]:
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    squared = (y - p) * (y - p)
    spread = F.when(F.min(y) < F.max(y), F.var_pop(y))
    return [
        F.sqrt(F.avg(squared)).alias(f"rmse{suffix}"),
        F.avg(F.abs(y - p)).alias(f"mae{suffix}"),
        (1.0 - F.try_divide(F.avg(squared), spread)).alias(f"r2{suffix}"),
    ]


def _rank_agreement(actual: str, predicted: str) -> Column:
    gap = (F.col("_actual_rank") - F.col("rank_ordinal")).cast("double")
    n = F.count("*").cast("double")
    varied = (F.min(actual) < F.max(actual)) & (F.min(predicted) < F.max(predicted))
    return F.when(varied, 1.0 - F.try_divide(6.0 * F.sum(gap * gap), n * (n * n - 1.0))).alias("rank_correlation")


def _helpful(actual: str) -> Column:
    return (F.col(actual) > 0).cast("double")


def _ranked_twice(
    df: DataFrame, actual: str, predicted: str, key: str, groups: Sequence[str], parts: int | None
) -> DataFrame:
    """Positions by the prediction next to the ordinal rank by the actual value."""
    first = (
        add_positions(df, actual, key, groups, parts)
        .withColumn("_actual_rank", F.col("rank_ordinal"))
        .drop(*RANK_COLUMNS)
    )
    return add_positions(first, predicted, key, groups, parts)


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, groups: Sequence[str] = (), suffix: str = ""
) -> DataFrame:
    """Root mean squared error, mean absolute error and R2, in one aggregation; R2 is NULL for a constant target."""
    pairs = df.dropna(subset=[actual, predicted])
    return _by(pairs, groups).agg(F.count("*").alias(f"rows{suffix}"), *_errors(actual, predicted, suffix))


def rank_correlation(
    df: DataFrame, actual: str, predicted: str, key: str, groups: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Correlation of ordinal ranks, ties in the order of the key; NULL when a side is constant."""
    pairs = df.select(*groups, key, actual, predicted).dropna(subset=[actual, predicted])
    both = _ranked_twice(pairs, actual, predicted, key, groups, parts)
    return _by(both, groups).agg(_rank_agreement(actual, predicted))


def top_decile_rate(
    df: DataFrame, actual: str, score: str, key: str, groups: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Share of rows with a positive actual value among the tenth with the highest score."""
    best = top_decile(df.select(*groups, key, actual, score), score, key, groups, parts)
    return _by(best, groups).agg(F.avg(_helpful(actual)).alias("top_decile_rate"))


def evaluate_predictions(
    df: DataFrame, key: str, actual: str, predicted: str, actual_log: str, predicted_log: str, groups: Sequence[str]
) -> DataFrame:
    """All metrics per group in one aggregation over rows that carry both ranks."""
    columns = dict.fromkeys([*groups, key, actual, predicted, actual_log, predicted_log])
    pairs = df.select(*columns).dropna(subset=[actual, predicted])
    both = _ranked_twice(pairs, actual, predicted, key, groups, None)
    in_top = F.col("rank_ordinal") > F.col("rank_n") - decile_size()
    return _by(both, groups).agg(
        F.count("*").alias("rows"),
        *_errors(actual, predicted),
        *_errors(actual_log, predicted_log, "_log"),
        _rank_agreement(actual, predicted),
        F.avg(F.when(in_top, _helpful(actual))).alias("top_decile_rate"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """Lowest RMSE, then MAE, then highest rank correlation, then top-decile rate; missing is worst."""
    return metrics.orderBy(
        F.asc_nulls_last("rmse"),
        F.asc_nulls_last("mae"),
        F.desc_nulls_last("rank_correlation"),
        F.desc_nulls_last("top_decile_rate"),
        "model_name",
    ).limit(1)
