"""Global ranks over any number of rows (WN operators) and the top decile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from venuelens.operators.bins import default_parts
from venuelens.operators.materialize import materialize
from venuelens.operators.quantiles import values_at_ranks


def ordered_cells(df: DataFrame, order: Sequence[str], parts: int) -> DataFrame:
    """The rows with ``_cell``, a number that follows the given order: each cell is one range of it.

    Spark cuts the ranges from a sample of whole sort keys, so a frequent value is cut by what follows it in the order. The
    rows are written, because the number is only fixed once it is stored.
    """
    return materialize(df.repartitionByRange(parts, *order).withColumn("_cell", F.spark_partition_id()))


def add_positions(
    df: DataFrame, value: str, key: str, groups: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Add ``rank_n``, ``rank_less``, ``rank_ties`` and ``rank_ordinal`` for an ascending order.

    ``key`` is unique, of any type with an order, and orders ties. Rows are dealt to ``parts`` ranges of (groups, value, key), so a frequent
    value is spread over tasks like any other rows. The row counts of the cells, of which there are at most ``parts`` and one more for
    each group, give each cell its offset. Only values that reach over the border of a cell, at most two for each
    cell, need more: their rows are counted over all cells. NULL values get NULL positions.
    """
    groups = list(groups)
    named = df.filter(F.col(value).isNotNull())
    rows = ordered_cells(named, [*groups, value, key], parts or default_parts(df))
    cell = [*groups, "_cell"]
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    before = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        rows.groupBy(*cell)
        .agg(F.count("*").alias("_rows"), F.min(value).alias("_first"), F.max(value).alias("_last"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn("rank_n", F.sum("_rows").over(whole))
    )
    cells = materialize(cells)
    borders = cells.select(*groups, F.explode(F.array("_first", "_last")).alias(value)).distinct()
    there = rows.join(borders, [*groups, value]).groupBy(*cell, value).agg(F.count("*").alias("_here"))
    start = F.col("_before") + F.when(F.col(value) == F.col("_first"), 0).otherwise(F.col("_rows") - F.col("_here"))
    spans = materialize(
        there.join(cells, cell)
        .groupBy(*groups, value)
        .agg(F.min(start).alias("_start"), F.sum("_here").alias("_ties"))
    )
    # Both windows read one sort: the order by (value, key) is also an order by value.
    order = Window.partitionBy(*cell).orderBy(value, key)
    peers = Window.partitionBy(*cell).orderBy(value)
    placed = (
        rows.withColumn("_row", F.row_number().over(order))
        .withColumn("_less", F.rank().over(peers) - 1)
        .withColumn("_same", F.count("*").over(peers.rangeBetween(Window.currentRow, Window.currentRow)))
        .join(cells.select(*cell, "_before", "rank_n"), cell)
        .join(spans, [*groups, value], "left")
    )
    ranked = placed.select(
        *df.columns,
        "rank_n",
        F.coalesce("_start", F.col("_before") + F.col("_less")).alias("rank_less"),
        F.coalesce("_ties", "_same").alias("rank_ties"),
        (F.col("_before") + F.col("_row")).alias("rank_ordinal"),
    )
    unplaced = df.filter(F.col(value).isNull())
    return ranked.unionByName(unplaced.withColumns({c: F.lit(None).cast("bigint") for c in RANK_COLUMNS}))


#: Texts that one buffer holds in the search for a key.
FEW = 50_000

RANK_COLUMNS = ("rank_n", "rank_less", "rank_ties", "rank_ordinal")


def add_predicted_ranks(df: DataFrame, value: str, key: str, parts: int | None = None) -> DataFrame:
    """Descending rank with the minimum for ties, and the ascending average-rank percentile."""
    return (
        add_positions(df, value, key, parts=parts)
        .withColumn("predicted_rank", F.col("rank_n") - F.col("rank_less") - F.col("rank_ties") + 1)
        .withColumn(
            "predicted_percentile",
            (F.col("rank_less") + (F.col("rank_ties") + 1) / F.lit(2.0)) / F.col("rank_n"),
        )
        .drop(*RANK_COLUMNS)
    )


def decile_size() -> Column:
    """Rows in the top tenth, at least one."""
    return F.greatest(F.lit(1), F.floor(F.col("rank_n") / 10))


def _nth_text(df: DataFrame, key: str, wanted: int) -> str:
    """The ``wanted``-th largest of unique texts by their bytes.

    Each pass counts the texts that go on from a prefix with each character and takes the character at which the wanted one lies, until
    few enough are left for one buffer. What reaches the driver is a row for each character of the alphabet.
    """
    texts, prefix = df.select(F.col(key).alias("_key")), ""
    while True:
        within = texts.filter(F.startswith("_key", F.lit(prefix)))
        if within.count() <= FEW:
            return within.agg(F.sort_array(F.collect_list("_key"), asc=False)).first()[0][wanted - 1]
        following = within.groupBy(F.substring("_key", len(prefix) + 1, 1).alias("next")).count().collect()
        for row in sorted(following, key=lambda r: r["next"].encode(), reverse=True):
            if wanted <= row["count"]:
                break
            wanted -= row["count"]
        if not row["next"]:  # the text that ends here
            return prefix
        prefix += row["next"]


def top_decile(df: DataFrame, score: str, key: str, groups: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """The tenth of the rows with the highest score, at least one row; ties go to the highest key.

    With groups this reads ranks. Without, the lowest score and key of the tenth are searched by counting passes: rows are
    neither sorted nor moved. Scores must be numbers then, and keys whole numbers or texts, ordered by their bytes.
    """
    if groups:
        return (
            add_positions(df, score, key, groups, parts)
            .filter(F.col("rank_ordinal") > F.col("rank_n") - decile_size())
            .drop(*RANK_COLUMNS)
        )
    total = df.filter(F.col(score).isNotNull()).count()
    if not total:
        return df.limit(0)
    keep = max(1, total // 10)
    cut = values_at_ranks(df, F.col(score).cast("double"), [total - keep])[0]
    value = F.col(score).cast("double")
    counts = df.agg(F.count_if(value > cut).alias("above"), F.count_if(value == cut).alias("at")).first()
    tied, wanted = df.filter(value == cut), keep - counts["above"]
    if wanted == counts["at"]:
        return df.filter(value >= cut)
    if isinstance(df.schema[key].dataType, T.StringType):
        return df.filter((value > cut) | ((value == cut) & (F.col(key) >= _nth_text(tied, key, wanted))))
    # Halves of a key are exact as doubles, whatever its size.
    high, low = F.shiftright(F.col(key).cast("bigint"), 32), F.col(key).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    top = int(values_at_ranks(tied, high.cast("double"), [counts["at"] - wanted])[0])
    inner = tied.agg(F.count_if(high > top).alias("above"), F.count_if(high == top).alias("at")).first()
    least = values_at_ranks(tied.filter(high == top), low.cast("double"), [inner["at"] - (wanted - inner["above"])])[0]
    return df.filter((value > cut) | ((value == cut) & ((high > top) | ((high == top) & (low >= int(least))))))
