"""Filters, fills and feature-column choice (PF operators)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from venuelens.operators.joins import without_listed
from venuelens.operators.profile import corr_matrix

LEAK_LIMIT = 0.999
# Fixed value: pattern of opening-hours texts that land in the cuisine field.
OPENING_HOURS = "Откроется|Закроется|Открыто|Сейчас|Сегодня|Меню"


def count_where(df: DataFrame, predicate: Column, name: str = "matching_rows") -> DataFrame:
    return df.agg(F.count_if(predicate).alias(name))


def reviewed_unrated(df: DataFrame, reviews: str, rating: str) -> DataFrame:
    """Rows that have reviews and still no rating."""
    return df.filter((F.col(reviews) != 0) & F.col(rating).isNull())


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def drop_junk(df: DataFrame, col: str, pattern: str = OPENING_HOURS) -> DataFrame:
    """Drop rows whose text matches a pattern; NULL text stays."""
    return df.filter(~F.coalesce(F.col(col), F.lit("")).rlike(pattern))


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in values.items()})


def clean_categories(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing categories become the text ``Unknown``; other types turn to text."""
    return df.withColumns({name: F.coalesce(F.col(name).cast("string"), F.lit("Unknown")) for name in cols})


def valid_target(df: DataFrame, target: str, minimum: int = 50) -> DataFrame:
    """Rows with a numeric target; raises when there are fewer than ``minimum``."""
    kept = df.filter(F.col(target).isNotNull())
    found = kept.select(target).limit(minimum).count()
    if found < minimum:
        raise ValueError(f"only {found} rows have a value in {target}, {minimum} are needed")
    return kept


def rare_values(df: DataFrame, col: str, value: str, min_count: int = 10) -> DataFrame:
    """Values of ``col`` with fewer than ``min_count`` non-NULL entries in ``value``."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(value).alias("value_count"))
        .filter(F.col("value_count") < min_count)
    )


def drop_rare(df: DataFrame, col: str, value: str, min_count: int = 10) -> DataFrame:
    """Drop rows of rare categories; rows without a category stay."""
    rare = rare_values(df, col, value, min_count).select(col)
    return without_listed(df, rare, col)


def feature_columns(df: DataFrame, target: str, technical: Sequence[str] = ()) -> list[str]:
    return [name for name in df.columns if name != target and name not in technical]


def leakage_check(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Correlation of every numeric feature with the target, and whether it gives the target away."""
    if target in features:
        raise ValueError(f"target {target} is among the features")
    pairs = corr_matrix(df, [target, *features], against=target)
    return pairs.select(
        F.col("col_b").alias("feature"),
        "corr",
        F.coalesce(F.abs("corr") >= LEAK_LIMIT, F.lit(False)).alias("leaks"),
    )


def cardinality(df: DataFrame, cols: Sequence[str], max_card: int = 100) -> DataFrame:
    """Distinct values per column, NULL counted as one, against an upper bound."""
    counts = df.agg(
        *[
            (F.count_distinct(name) + F.max(F.col(name).isNull().cast("int"))).cast("bigint").alias(name)
            for name in cols
        ]
    )
    return counts.select(
        F.inline(
            F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("distinct_values")) for name in cols])
        )
    ).withColumn("low_cardinality", F.col("distinct_values") <= max_card)


def feature_types(
    df: DataFrame,
    target: str,
    technical: Sequence[str] = (),
    categorical: Sequence[str] = ("division_name", "department_name", "class_name"),
    text: Sequence[str] = ("combined_text", "review_text", "title"),
    max_card: int = 100,
) -> dict[str, list[str]]:
    """Numeric columns by type, allowed low-cardinality categories, and the first text column present."""
    usable = feature_columns(df, target, technical)
    types = {field.name: field.dataType for field in df.schema.fields}
    numeric = [name for name in usable if isinstance(types[name], T.NumericType)]
    candidates = [name for name in categorical if name in usable and name not in numeric]
    low = []
    if candidates:
        rows = cardinality(df, candidates, max_card).filter("low_cardinality").collect()
        low = [row["column_name"] for row in rows]
    return {
        "numeric": numeric,
        "categorical": [name for name in candidates if name in low],
        "text": [name for name in text if name in usable][:1],
    }


def with_constant_feature(df: DataFrame, numeric: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A constant column stands in when there is no numeric feature at all."""
    if numeric:
        return df, list(numeric)
    return df.withColumn("constant_feature", F.lit(1.0)), ["constant_feature"]
