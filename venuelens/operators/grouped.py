"""Exact quantiles of groups of any size, without a row of a group in any shuffle (ST-14)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from venuelens.operators.materialize import materialize

#: Values that one aggregation buffer of a group may hold.
SMALL = 50_000
GRID, ACCURACY = 200, 2000


def _grid(x: Column) -> Column:
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return F.percentile_approx(x, steps, ACCURACY)


def _between(rank: Column) -> list[Column]:
    """Bounds (low, high) and ``fits`` of a search: by its grid, ``margin`` steps to either side of the rank."""
    place = F.floor((rank - F.col("base")) / F.col("inside") * GRID).cast("int")
    down, up = place - F.col("margin"), place + 1 + F.col("margin")
    share = (2 * F.col("margin") + 1) / F.lit(float(GRID)) + 2 / ACCURACY
    return [
        F.when(down >= 0, F.get("grid", down)).otherwise(F.col("least")).alias("low"),
        F.when(up <= GRID, F.get("grid", up)).otherwise(F.col("most")).alias("high"),
        ((F.col("inside") <= SMALL) | (F.col("inside") * share <= SMALL)).alias("fits"),
    ]


_STATE = ["_group", "rank", "base", "inside", "least", "most", "grid", "margin"]


def _search(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """(_group, rank, value) of all ``ranks`` (_group, rank): the values at these places, from 0, of each group's ascending order in ``rows`` (_group, _v).

    A sketch of each group bounds the rank; every pass then counts what lies below, at and between the bounds and sketches the
    inside, until that fits a buffer. A miss shows in the counts and widens the bounds. All that is shuffled is one row for each rank and task.
    """
    first = rows.groupBy("_group").agg(F.count("_v").alias("inside"), F.min("_v").alias("least"), F.max("_v").alias("most"), _grid(F.col("_v")).alias("grid"))
    state = materialize(ranks.join(first, "_group").select("_group", "rank", F.lit(0).cast("long").alias("base"), "inside", "least", "most", "grid", F.lit(1).alias("margin")))
    done = None
    while True:
        asked = materialize(state.select("*", *_between(F.col("rank"))))
        v, low, high = F.col("_v"), F.col("low"), F.col("high")
        inner = F.when((v > low) & (v < high), v)
        counted = rows.join(asked.select("_group", "rank", "low", "high", "fits"), "_group").groupBy("_group", "rank").agg(
            F.count_if(v < low).alias("below"), F.count_if(v == low).alias("at_low"), F.count_if(v == high).alias("at_high"), F.count(inner).alias("n"),
            F.min(inner).alias("first"), F.max(inner).alias("last"), _grid(F.when(~F.col("fits"), inner)).alias("finer"),
            F.sort_array(F.collect_list(F.when(F.col("fits"), inner))).alias("values"),
        )
        k = F.col("rank") - F.col("below") - F.col("at_low")
        within = (k >= 0) & (k < F.col("n"))
        value = (
            F.when((k < 0) & (k >= -F.col("at_low")), low)
            .when(within & F.col("fits"), F.get("values", k.cast("int")))
            .when((k >= F.col("n")) & (low < high) & (k < F.col("n") + F.col("at_high")), high)
        )
        seen = materialize(asked.join(counted, ["_group", "rank"]).withColumns({"value": value, "_within": within}))
        found = seen.where("value is not null").select("_group", "rank", "value")
        done = found if done is None else done.union(found)
        left = seen.where("value is null")
        if left.isEmpty():
            return done
        # Where the rank lies inside, the inside is searched next; where not, the bounds were missed and are set wider.
        closer = lambda new, old: F.when(F.col("_within"), new).otherwise(F.col(old)).alias(old)
        state = left.select(
            "_group", "rank", closer(F.col("below") + F.col("at_low"), "base"), closer(F.col("n"), "inside"), closer(F.col("first"), "least"),
            closer(F.col("last"), "most"), closer(F.col("finer"), "grid"),
            F.when(F.col("_within"), F.lit(1)).otherwise(F.col("margin") * 8).alias("margin"),
        ).select(_STATE)


def group_quantiles(df: DataFrame, group: str, value: str, probs: Mapping[str, float]) -> DataFrame:
    """(group, n, a column for each entry of ``probs``): exact, linearly interpolated quantiles of each group; NULL values and groups are left out.

    A group of up to SMALL values is one buffer of Spark's exact percentile, built up in the tasks. Larger groups are searched by counting
    passes; of these there are at most rows / SMALL, so their bounds are a small table next to the rows.
    """
    rows = df.select(F.col(group).alias("_group"), F.col(value).cast("double").alias("_v")).dropna()
    sizes = materialize(rows.groupBy("_group").agg(F.count("*").alias("n")))
    large = materialize(sizes.where(F.col("n") > SMALL))
    asked = F.array(*[F.lit(float(p)) for p in probs.values()])
    searched = not large.isEmpty()
    few = rows.join(large, "_group", "left_anti") if searched else rows
    out = few.groupBy("_group").agg(F.count("*").alias("n"), F.percentile("_v", asked).alias("q"))
    out = out.select(F.col("_group").alias(group), "n", *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(probs)])
    if not searched:
        return out
    spot = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(spot(p)), F.ceil(spot(p))) for p in probs.values()])))
    values = materialize(_search(rows.join(large.select("_group"), "_group", "left_semi"), large.select("_group", F.explode(ranks).alias("rank"))))
    by_rank = large.join(values.groupBy("_group").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")), "_group")
    columns = []
    for name, p in probs.items():
        low, high = (F.element_at("at", f(spot(p))) for f in (F.floor, F.ceil))
        columns.append(F.when(low == high, low).otherwise(low + (high - low) * (spot(p) - F.floor(spot(p)))).alias(name))
    return out.union(by_rank.select(F.col("_group").alias(group), "n", *columns))


def box_rows(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges, and outliers per group.

    The fences of each group are joined to its rows (one row a group; Spark sends it to the rows where it is small) and the rest is counted in place.
    """
    quartiles = materialize(group_quantiles(df, group, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})).withColumnRenamed(group, "_group")
    rows = df.select(F.col(group).alias("_group"), F.col(value).cast("double").alias("_v")).dropna()
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    stats = rows.join(quartiles.select("_group", "q1", "q3"), "_group").groupBy("_group").agg(
        F.min(F.when(inside, F.col("_v"))).alias("_low"), F.max(F.when(inside, F.col("_v"))).alias("_high"), F.count_if(~inside).alias("outliers")
    )
    return quartiles.join(stats, "_group").select(
        F.col("_group").alias(group), "n", "q1", "median", "q3",
        F.least("_low", "q1").alias("whisker_low"), F.greatest("_high", "q3").alias("whisker_high"), "outliers",
    )
