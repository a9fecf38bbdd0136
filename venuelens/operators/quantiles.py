"""Exact interpolated quantiles without holding a group in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from venuelens.operators.bins import Ranges, add_bin, default_parts, find_ranges
from venuelens.operators.materialize import materialize


def collapse(df: DataFrame, value: str, groups: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Rows per (group, value) as (groups, ``_v``, ``_w``), written once because several steps read them.

    NULL values and NULL groups are left out.
    """
    amount = F.count("*") if weight is None else F.sum(weight)
    counts = (
        df.dropna(subset=[value, *groups])
        .groupBy(*groups, F.col(value).cast("double").alias("_v"))
        .agg(amount.cast("bigint").alias("_w"))
    )
    return materialize(counts)


def count_ranges(counts: DataFrame, parts: int | None = None) -> Ranges:
    """Value ranges that hold about equally many collapsed rows of all groups together."""
    return find_ranges(counts, {"v": "_v"}, parts or default_parts(counts))["v"]


def quantiles_of_counts(
    counts: DataFrame, probs: Mapping[str, float], groups: Sequence[str] = (), ranges: Ranges | None = None
) -> DataFrame:
    """Quantiles of collapsed rows (see ``collapse``): one row per group with ``n`` and a column per entry.

    The bin totals of a group give every bin its offset, so running counts are formed inside
    (group, bin) cells, which are small even when one group holds most of the rows.
    """
    groups = list(groups)
    binned = add_bin(counts, "_v", ranges or count_ranges(counts), "_bin")
    cell = [*groups, "_bin"]
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        binned.groupBy(*cell)
        .agg(F.sum("_w").alias("_cell"))
        .select(
            *cell,
            F.coalesce(F.sum("_cell").over(before), F.lit(0)).alias("_before"),
            F.sum("_cell").over(whole).alias("n"),
        )
    )
    inside = Window.partitionBy(*cell).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        binned.withColumn("_upto", F.sum("_w").over(inside))
        .join(cells, cell)
        .withColumn("_upto", F.col("_upto") + F.col("_before"))
    )

    picks = [F.max("n").alias("n")]
    for name, prob in probs.items():
        place = F.lit(float(prob)) * (F.col("n") - 1)
        picks.append(F.min(F.when(F.col("_upto") > F.floor(place), F.col("_v"))).alias(f"_low_{name}"))
        picks.append(F.min(F.when(F.col("_upto") > F.ceil(place), F.col("_v"))).alias(f"_high_{name}"))
    picked = running.groupBy(*groups).agg(*picks)

    columns = [*[F.col(g) for g in groups], F.col("n")]
    for name, prob in probs.items():
        place = F.lit(float(prob)) * (F.col("n") - 1)
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        columns.append(F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(name))
    return picked.select(*columns)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    groups: Sequence[str] = (),
    weight: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, for any number of groups of any size."""
    counts = collapse(df, value, groups, weight)
    return quantiles_of_counts(counts, probs, groups, count_ranges(counts, parts))


SMALL = 50_000  # values one aggregation buffer may hold
GRID = 200
_STEPS = "array(" + ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1)) + ")"
_ACCURACY = 2000  # the rank of a sketched value is off by at most one row in so many


def number(c: str) -> Column:
    """A column as double, NaN as NULL."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def extent(x: Column) -> list[Column]:
    """What bounds the number of distinct values of a column cheaply."""
    return [F.count(x).alias("n"), F.approx_count_distinct(x, 0.05).alias("distinct")]


def _distinct_bound(seen: Row) -> int:
    """The number of distinct values by a sketch, with four standard errors on top.

    Whichever way it decides, the quantiles are exact and the work is bounded.
    """
    return int(1.2 * seen["distinct"])


def _outline(x: Column) -> Column:
    """What a pass must tell about values to look for quantiles among them."""
    return F.struct(
        F.count(x).alias("n"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
        F.percentile_approx(x, F.expr(_STEPS), _ACCURACY).alias("grid"),
    )


@dataclass
class _Search:
    """The value at one rank (from 0) of a column, one of ``n`` values from ``low`` to ``high``."""

    col: str
    rank: int
    n: int
    low: float
    high: float
    grid: list[float]
    below: int = 0
    margin: int = 1
    value: float | None = None

    def bounds(self) -> tuple[float, float]:
        """Closer bounds by the sketch; a miss shows in the next counts and widens the margin."""
        place = int((self.rank - self.below) / self.n * GRID)
        down, up = place - self.margin, place + 1 + self.margin
        return self.grid[down] if down >= 0 else self.low, self.grid[up] if up <= GRID else self.high

    def fits(self) -> bool:
        """Whether what lies between the bounds surely fits a buffer."""
        share = (2 * self.margin + 1) / GRID + 2 / _ACCURACY
        return self.n <= SMALL or self.n * share <= SMALL

    def learn(self, seen: Row, low: float, high: float) -> None:
        """Take in the counts below, at and between the bounds."""
        inner = seen["inner"]
        k = self.rank - seen["below"] - seen["at_low"]
        if -seen["at_low"] <= k < 0:
            self.value = low
        elif 0 <= k < inner["n"]:
            if self.fits():
                self.value = seen[f"at_{self.rank}"]
            else:
                self.n, self.low, self.high, self.grid = inner["n"], inner["low"], inner["high"], inner["grid"]
                self.below, self.margin = seen["below"] + seen["at_low"], 1
        elif low < high and 0 <= k - inner["n"] < seen["at_high"]:
            self.value = high
        else:
            self.margin *= 8


def values_at_ranks(df: DataFrame, value: Column, ranks: Sequence[int]) -> list[float]:
    """The values at some places, from 0, of the ascending order of a column's values; counting passes, no shuffle of rows."""
    narrow = df.select(value.alias("value"))
    first = narrow.agg(_outline(number("value")).alias("value")).first()
    searches = {
        ("value", r): _Search("value", r, first["value"]["n"], first["value"]["low"], first["value"]["high"], first["value"]["grid"])
        for r in ranks
    }
    _run(narrow, searches)
    return [searches["value", r].value for r in ranks]


def _search(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float]) -> dict[str, dict[str, float]]:
    """Quantiles of columns with very many values, without a shuffle of values.

    Every pass counts what lies below and between the bounds of each searched rank and sketches the
    inside, which leaves about one candidate in 70. Once the candidates fit a buffer of ``SMALL``
    values the rank is read off; only single values and sketches of fixed size reach the driver.
    Three million rows take two passes, 10^12 rows five.
    """
    first = df.agg(*[_outline(number(c)).alias(c) for c in cols]).first()
    places = {c: {q: p * (first[c]["n"] - 1) for q, p in probs.items()} for c in cols}
    searches = {
        (c, rank): _Search(c, rank, first[c]["n"], first[c]["low"], first[c]["high"], first[c]["grid"])
        for c, spots in places.items()
        for spot in spots.values()
        for rank in (math.floor(spot), math.ceil(spot))
    }
    _run(df, searches)
    result: dict[str, dict[str, float]] = {c: {} for c in cols}
    for c, spots in places.items():
        for q, spot in spots.items():
            low, high = searches[c, math.floor(spot)].value, searches[c, math.ceil(spot)].value
            result[c][q] = low if low == high else low + (high - low) * (spot - math.floor(spot))
    return result


def _run(df: DataFrame, searches: Mapping[tuple[str, int], _Search]) -> None:
    """Pass over the rows until every search has its value."""
    while pending := [s for s in searches.values() if s.value is None]:
        ranges: dict[tuple, list[_Search]] = {}
        for s in pending:
            ranges.setdefault((s.col, *s.bounds(), s.fits()), []).append(s)
        measures = []
        for i, ((c, low, high, small), members) in enumerate(ranges.items()):
            x = number(c)
            below, at_low = F.count_if(x < low), F.count_if(x == low)
            inner = F.when((x > low) & (x < high), x)
            parts = [below.alias("below"), at_low.alias("at_low"), F.count_if(x == high).alias("at_high")]
            if small:
                values = F.sort_array(F.collect_list(inner))
                parts.append(F.struct(F.count(inner).alias("n")).alias("inner"))
                parts += [F.get(values, (F.lit(s.rank) - below - at_low).cast("int")).alias(f"at_{s.rank}") for s in members]
            else:
                parts.append(_outline(inner).alias("inner"))
            measures.append(F.struct(*parts).alias(f"range_{i}"))
        row = df.agg(*measures).first()
        for i, ((_, low, high, _), members) in enumerate(ranges.items()):
            for s in members:
                s.learn(row[f"range_{i}"], low, high)


def column_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Mapping[str, float], extents: Mapping[str, Row] | None = None
) -> dict[str, dict[str, float | None]]:
    """Exact interpolated quantiles of whole columns.

    Columns that have at most about ``SMALL`` distinct values shrink to counts per value, all in one
    pass, and Spark's exact percentile reads those; other columns are searched. ``extents`` holds the
    ``extent`` of every column where the caller has it.
    """
    if extents is None:
        extents = df.agg(*[F.struct(*extent(number(c))).alias(c) for c in cols]).first()
    distinct = {c: _distinct_bound(extents[c]) for c in cols}
    result: dict[str, dict[str, float | None]] = {c: dict.fromkeys(probs) for c in cols}
    few = [c for c in cols if 0 < distinct[c] <= SMALL]
    many = [c for c in cols if distinct[c] > SMALL]
    if few:
        asked = F.array(*[F.lit(float(p)) for p in probs.values()])
        counts = (
            df.select(*[number(c).alias(c) for c in few])
            .unpivot([], few, "column_name", "value")
            .filter("value IS NOT NULL")
            .groupBy("column_name", "value")
            .agg(F.count("*").alias("row_count"))
        )
        for row in counts.groupBy("column_name").agg(F.percentile("value", asked, F.col("row_count")).alias("found")).collect():
            result[row["column_name"]] = dict(zip(probs, row["found"]))
    if many:
        result.update(_search(df, many, probs))
    return result
