"""Depth-balanced value ranges that spread a global order over many tasks."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

EXACT_LIMIT = 2.0**53


@dataclass(frozen=True)
class Ranges:
    """Cut points of a column and the bins that hold one single, frequent value."""

    cuts: tuple[float, ...]
    single: tuple[int, ...]


def default_parts(df: DataFrame) -> int:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, 2 * tasks)


def find_ranges(df: DataFrame, cols: Mapping[str, str], parts: int) -> dict[str, Ranges]:
    """Cut points of every column, from one pass with a quantile sketch of bounded size.

    A value that the sketch returns for several cut points is frequent; it gets a bin of its own, which
    callers may split further.
    """
    steps = F.expr("array(" + ", ".join(f"{i / parts!r}D" for i in range(1, parts)) + ")") if parts > 1 else F.array(F.lit(0.5))
    # A rank error of a quarter of a bin keeps the sketches of many tasks small.
    sketches = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), steps, max(1000, 4 * parts)).alias(name) for name, c in cols.items()]
    ).first()
    result = {}
    for name in cols:
        found = [v for v in (sketches[name] or []) if math.isfinite(v)]
        frequent = {a for a, b in zip(found, found[1:]) if a == b and abs(a) < EXACT_LIMIT}
        cuts = sorted(set(found) | {math.nextafter(v, math.inf) for v in frequent})
        single = tuple(i + 1 for i, v in enumerate(cuts) if v in frequent)
        result[name] = Ranges(tuple(cuts), single)
    return result


def add_bin(df: DataFrame, col: str, ranges: Ranges, name: str) -> DataFrame:
    """Bin number of a value; bins follow the order of the values, NULL goes to bin -1."""
    if not ranges.cuts:
        return df.withColumn(name, F.when(F.col(col).isNull(), F.lit(-1)).otherwise(F.lit(0)))
    number = f"{name}_number"
    bucketizer = Bucketizer(
        splits=[-math.inf, *ranges.cuts, math.inf], inputCol=number, outputCol=name, handleInvalid="keep"
    )
    binned = bucketizer.transform(df.withColumn(number, F.col(col).cast("double")))
    return binned.withColumn(
        name, F.when(F.col(col).isNull(), F.lit(-1)).otherwise(F.col(name).cast("int"))
    ).drop(number)
