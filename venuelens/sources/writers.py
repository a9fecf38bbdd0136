"""Sinks for prepared tables, predictions and reports (SNK-1 to SNK-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_prepared(df: DataFrame, path: str, format: str = "parquet") -> None:
    writer = df.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.options(header=True, quote='"', escape='"')
    writer.save(path)


def write_predictions(df: DataFrame, path: str, *copies: str) -> None:
    """Compute and write once; copies are made from the written table."""
    df.write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    for copy in copies:
        written.write.mode("overwrite").parquet(copy)


def write_report(df: DataFrame, path: str) -> None:
    """A report is small: one file."""
    df.repartition(1).write.mode("overwrite").parquet(path)
