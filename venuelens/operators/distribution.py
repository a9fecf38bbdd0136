"""Histograms, binned means, box summaries and grids (ST-12 to ST-15)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from venuelens.operators.grouped import box_rows
from venuelens.operators.quantiles import column_quantiles, extent


@dataclass(frozen=True)
class Axis:
    """Equal-width bins between two bounds."""

    low: float
    high: float
    bins: int

    @property
    def width(self) -> float:
        return (self.high - self.low) / self.bins

    def edge(self, i: Column) -> Column:
        return F.lit(self.low) + i * F.lit(self.width)

    def left_closed(self, x: Column) -> Column:
        """Bin of a histogram: left edge included, the maximum in the last bin."""
        guess = F.least(F.floor((x - self.low) / (self.high - self.low) * self.bins).cast("bigint"), F.lit(self.bins - 1))
        down = (x < self.edge(guess)).cast("int")
        up = ((x >= self.edge(guess + 1)) & (guess < self.bins - 1)).cast("int")
        return (guess - down + up).cast("bigint")

    def right_closed(self, x: Column) -> Column:
        """Bin of a cut: right edge included, the minimum in the first bin."""
        guess = F.greatest(F.ceil((x - self.low) / (self.high - self.low) * self.bins).cast("bigint") - 1, F.lit(0))
        down = ((x <= self.edge(guess)) & (guess > 0)).cast("int")
        up = ((x > self.edge(guess + 1)) & (guess < self.bins - 1)).cast("int")
        return F.least(guess - down + up, F.lit(self.bins - 1)).cast("bigint")


def _bounds(df: DataFrame, *cols: str) -> list[tuple[float | None, float | None]]:
    x = [F.col(c).cast("double") for c in cols]
    row = df.agg(*[f(c) for c in x for f in (F.min, F.max)]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(cols))]


def _histogram_axis(low: float | None, high: float | None, bins: int) -> Axis:
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    return Axis(low, high, bins)


def _cut_axis(low: float | None, high: float | None, bins: int) -> Axis:
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        room = 0.001 * abs(low) if low != 0 else 0.001
        low, high = low - room, high + room
    return Axis(low, high, bins)


def _all_bins(df: DataFrame, axis: Axis, filled: DataFrame) -> DataFrame:
    """Every bin once, with its edges; ``filled`` has at most one row per bin."""
    frame = df.sparkSession.range(axis.bins).select(F.col("id").alias("bin"))
    return frame.join(F.broadcast(filled), "bin", "left").select(
        "bin",
        axis.edge(F.col("bin")).alias("lower"),
        axis.edge(F.col("bin") + 1).alias("upper"),
        *[c for c in filled.columns if c != "bin"],
    )


def automatic_bins(df: DataFrame, col: str) -> int:
    """How many equal-width bins suit a column: the data set the width.

    The smaller of the Freedman-Diaconis width 2 * (q3 - q1) / n ** (1/3), with exact quartiles, and the Sturges width (max - min) / (log2(n) + 1). The
    first is at least (max - min) / sqrt(n) / 2, so that there are never more than 2 * sqrt(n) bins, whatever
    the outliers. Bins of a whole-number column are at least 1 wide. One bin for a constant column or one without values.
    """
    x = F.col(col).cast("double")
    row = df.agg(F.struct(*extent(x)).alias("seen"), F.min(x).alias("low"), F.max(x).alias("high")).first()
    n = row["seen"]["n"]
    if not n or row["low"] == row["high"]:
        return 1
    spread = row["high"] - row["low"]
    found = column_quantiles(df, [col], {"q1": 0.25, "q3": 0.75}, {col: row["seen"]})[col]
    middle = 2.0 * (found["q3"] - found["q1"]) / n ** (1.0 / 3.0)
    width = min(max(middle, spread / math.sqrt(n) / 2), spread / (math.log2(n) + 1.0))
    if isinstance(df.schema[col].dataType, IntegralType):
        width = max(width, 1.0)
    return math.ceil(spread / width)


def histogram(df: DataFrame, col: str, bins: int | str = 30) -> DataFrame:
    """Row count per equal-width bin, empty bins included; ``bins`` is a number or ``auto``, see ``automatic_bins``."""
    axis = _histogram_axis(*_bounds(df, col)[0], automatic_bins(df, col) if bins == "auto" else bins)
    x = F.col(col).cast("double")
    filled = df.filter(x.isNotNull()).groupBy(axis.left_closed(x).alias("bin")).agg(F.count("*").alias("row_count"))
    return _all_bins(df, axis, filled).withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))


def binned_mean(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Mean of y per equal-width bin of x over rows where both are present; empty bins have NULL."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    axis = _cut_axis(*_bounds(both, x)[0], bins)
    filled = both.groupBy(axis.right_closed(F.col(x).cast("double")).alias("bin")).agg(
        F.count("*").alias("row_count"), F.avg(y).alias("mean")
    )
    return _all_bins(df, axis, filled).withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))


def scatter_grid(df: DataFrame, x: str, y: str, nx: int = 50, ny: int = 50) -> DataFrame:
    """Rows per cell of a grid: the density of a scatter plot in at most nx * ny rows."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    bounds = _bounds(both, x, y)
    across, up = _histogram_axis(*bounds[0], nx), _histogram_axis(*bounds[1], ny)
    return both.groupBy(
        across.left_closed(F.col(x).cast("double")).alias("x_bin"),
        up.left_closed(F.col(y).cast("double")).alias("y_bin"),
    ).agg(F.count("*").alias("row_count"))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges, and outliers per group; see ``grouped``."""
    return box_rows(df, group, value)
