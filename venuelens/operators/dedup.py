"""Duplicate counting and removal (CL operators)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a whole row, column names included, so that wide rows need not be shuffled."""
    fields = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)  # -0.0 and 0.0 are the same value
        elif isinstance(field.dataType, T.TimestampType):
            value = F.unix_micros(value)  # JSON would keep milliseconds only
        elif isinstance(field.dataType, T.TimestampNTZType):
            value = value.cast("string")
        fields.append(value.alias(field.name))
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def duplicate_digests(df: DataFrame, digest: str) -> DataFrame:
    """Rows whose digest repeats an earlier one."""
    copies = df.groupBy(digest).agg(F.count("*").alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column, NULLs equal."""
    return duplicate_digests(df.select(F.unhex(row_digest(df)).alias("digest")), "digest")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row of each group of equal rows; copies collapse in the map tasks already."""
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row per key. ``order`` must be unique within a key.

    The rank filter is also applied before the shuffle (WindowGroupLimit), so a hot key sends one row
    per map task.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys, NULL counted as one."""
    has_null = F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    return df.agg((F.count_distinct(key) + has_null).cast("bigint").alias("distinct_ids"))


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of all batches by column name; columns a batch lacks are NULL."""
    result = batches[0]
    for batch in batches[1:]:
        result = result.unionByName(batch, allowMissingColumns=True)
    return result
