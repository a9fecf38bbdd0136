"""Quality and distribution profiles of a table (ST-1 to ST-7, SNK-3)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from venuelens.functions.text import char_count, combined_text, is_blank, text_or_empty, word_count
from venuelens.operators.dedup import duplicate_digests, row_digest
from venuelens.operators.distribution import binned_mean
from venuelens.operators.gram import gram_correlations
from venuelens.operators.materialize import materialize
from venuelens.operators.quantiles import column_quantiles, extent, number, quantiles_of_counts


def _one_row_to_rows(df: DataFrame, records: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*records)))


def _is_missing(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def missing_profile(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Missing values per column, and whether their share is above a threshold; one pass."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(_is_missing(df, c)).alias(c) for c in df.columns])
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.col("_rows"))
    return _one_row_to_rows(
        counts,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("missing_count"),
                share(c).alias("missing_share"),
                F.coalesce(share(c) > threshold, F.lit(False)).alias("mostly_missing"),
            )
            for c in df.columns
        ],
    )


def overview(df: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Columns in order with their type and the number of rows, counted on ``rows`` if given."""
    return _one_row_to_rows(
        (df if rows is None else rows).agg(F.count("*").alias("row_count")),
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("row_count"),
            )
            for i, field in enumerate(df.schema.fields, start=1)
        ],
    )


SPREAD = ("count", "missing_count", "min", "max", "mean", "median", "std")
_NUMBERS_SCHEMA = (
    "column_name string, count bigint, missing_count bigint, min double, max double, mean double, median double,"
    " std double, zero_count bigint, zero_share_all double, zero_share_valid double, skewness double"
)


def number_profile(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """All figures of numeric columns, one row each.

    One pass gives everything but the exact medians, which take another (see ``column_quantiles``).
    ``approx=True`` sketches the medians in the same pass. The result has one row per column
    and is built from those figures.
    """
    df = df.select(*cols)
    measures = []
    for c in cols:
        x = number(c)
        n = F.count(x).cast("double")
        zeros = F.count_if(x == 0)
        measures.append(
            F.struct(
                (F.count("*") - F.count(x)).alias("missing"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                zeros.alias("zeros"),
                F.try_divide(zeros.cast("double"), F.count("*")).alias("share_all"),
                F.try_divide(zeros.cast("double"), F.count(x)).alias("share_valid"),
                F.when(
                    n >= 3, F.coalesce(F.skewness(x) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)), F.lit(0.0))
                ).alias("skewness"),
                *extent(x),
                F.min(x).alias("low"),
                F.max(x).alias("high"),
                *([F.percentile_approx(x, 0.5).alias("approx")] if approx else []),
            ).alias(c)
        )
    seen = df.agg(*measures).first()
    if approx:
        medians = {c: seen[c]["approx"] for c in cols}
    else:
        found = column_quantiles(df, cols, {"median": 0.5}, seen)
        medians = {c: found[c]["median"] for c in cols}
    order = ("n", "missing", "low", "high", "mean", "median", "std", "zeros", "share_all", "share_valid", "skewness")
    rows = [(c, *[medians[c] if m == "median" else seen[c][m] for m in order]) for c in cols]
    return df.sparkSession.createDataFrame(rows, _NUMBERS_SCHEMA)


def numeric_profile(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Count, missing, min, max, mean, median and sample deviation per column."""
    return number_profile(df, cols, approx).select("column_name", *SPREAD)


def target_profile(df: DataFrame, target: str, zero_denominator: str = "all") -> DataFrame:
    """Numeric profile of the target with zero share and adjusted skewness.

    The share of zeros is taken of all rows (``"all"``) or of the rows with a target (``"valid"``).
    """
    if zero_denominator not in ("all", "valid"):
        raise ValueError("zero_denominator must be 'all' or 'valid'")
    return number_profile(df, [target]).select(
        "column_name", *SPREAD, "zero_count", F.col(f"zero_share_{zero_denominator}").alias("zero_share"), "skewness"
    )


_LENGTHS = tuple(f"{m}_{s}" for m in ("chars", "words") for s in ("mean", "median", "min", "max"))


def measure_texts(texts: dict[str, Column], null_mode: str = "drop") -> dict[str, Column]:
    """Length in characters and words, missing and blank of each text, as ``<name>__<measure>``."""
    if null_mode not in ("drop", "empty"):
        raise ValueError("null_mode must be 'drop' or 'empty'")
    measures = {}
    for name, raw in texts.items():
        text = text_or_empty(raw) if null_mode == "empty" else raw
        measures[f"{name}__chars"] = char_count(text)
        measures[f"{name}__words"] = word_count(text)
        measures[f"{name}__missing"] = raw.isNull().cast("bigint")
        measures[f"{name}__blank"] = F.coalesce(is_blank(text), F.lit(False)).cast("bigint")
    return measures


def measured_text_profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text profile of the columns made by ``measure_texts``.

    The measures shrink to counts per (column, measure, value), which all figures come from; there are
    at most as many as there are different lengths.
    """
    records = [
        F.struct(F.lit(name).alias("column_name"), F.lit(m).alias("measure"), F.col(f"{name}__{m}").alias("value"))
        for name in names
        for m in ("chars", "words", "missing", "blank")
    ]
    counts = materialize(
        df.select(F.inline(F.array(*records)))
        .groupBy("column_name", "measure", "value")
        .agg(F.count("*").alias("row_count"))
    )
    of = lambda m, c: F.when(F.col("measure") == m, c)
    total = lambda m: F.coalesce(F.sum(of(m, F.col("value") * F.col("row_count"))), F.lit(0)).cast("bigint")
    weight = lambda m: F.sum(of(m, F.when(F.col("value").isNotNull(), F.col("row_count"))))
    stats = [total("missing").alias("missing_count"), total("blank").alias("blank_count")]
    for m in ("chars", "words"):
        stats += [
            F.try_divide(total(m).cast("double"), weight(m)).alias(f"{m}_mean"),
            F.min(of(m, F.col("value"))).alias(f"{m}_min"),
            F.max(of(m, F.col("value"))).alias(f"{m}_max"),
        ]
    lengths = counts.filter(F.col("measure").isin("chars", "words") & F.col("value").isNotNull()).select(
        "column_name", "measure", F.col("value").cast("double").alias("_v"), F.col("row_count").alias("_w")
    )
    medians = (
        quantiles_of_counts(lengths, {"median": 0.5}, ["column_name", "measure"])
        .groupBy("column_name")
        .agg(*[F.max(of(m, F.col("median"))).alias(f"{m}_median") for m in ("chars", "words")])
    )
    return (
        counts.groupBy("column_name")
        .agg(*stats)
        .join(F.broadcast(medians), "column_name", "left")  # one row per text column
        .select("column_name", "missing_count", "blank_count", *_LENGTHS)
    )


def text_profile(df: DataFrame, cols: Sequence[str], null_mode: str = "drop") -> DataFrame:
    """Length in characters and words per text column, plus missing and blank texts; one pass over the texts.

    ``"drop"`` leaves NULL texts out of the lengths, ``"empty"`` measures them as empty.
    """
    measures = measure_texts({c: F.col(c) for c in cols}, null_mode)
    return measured_text_profile(df.select(*[m.alias(name) for name, m in measures.items()]), cols)


FEW = 24


def corr_matrix(df: DataFrame, cols: Sequence[str], against: str | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are present.

    ``against`` keeps only the pairs with that column. A constant column gives NULL. One pass with five aggregates a pair; all pairs of more than
    ``FEW`` columns come from products of column blocks instead, see ``gram``, as a plan with that many aggregates could not be run.
    """
    if against is None and len(cols) > FEW:
        return gram_correlations(df, cols)
    pairs = [p for p in combinations(cols, 2) if against is None or p[0] == against]
    measures = []
    for i, (a, b) in enumerate(pairs):
        x, y = number(a), number(b)
        both = x.isNotNull() & y.isNotNull()
        spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
        measures.append(F.try_divide(F.covar_pop(x, y), spread).alias(f"r{i}"))
    return _one_row_to_rows(
        df.agg(*measures),
        [
            F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)
        ],
    )


def category_profile(df: DataFrame, cols: Sequence[str], k: int = 10, keep_null: bool = True) -> DataFrame:
    """The k most frequent values of each column with its distinct and missing counts.

    Ties go to the smaller value. With ``keep_null`` a missing value competes for a place.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    counts = (
        texts.unpivot([], list(cols), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("value_count"))
    )
    totals = counts.groupBy("column_name").agg(
        F.count("value").alias("distinct_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("value_count"))), F.lit(0)).alias("missing_count"),
    )
    listed = counts if keep_null else counts.filter(F.col("value").isNotNull())
    order = Window.partitionBy("column_name").orderBy(F.desc("value_count"), F.asc_nulls_last("value"))
    top = listed.withColumn("value_rank", F.row_number().over(order)).filter(F.col("value_rank") <= k)
    # Both sides are bounded by the number of columns (times k).
    return top.join(F.broadcast(totals), "column_name").select(
        "column_name", "distinct_count", "missing_count", "value_rank", "value", "value_count"
    )


def _metrics(df: DataFrame, section: str, names: Sequence, label: Column | None = None) -> DataFrame:
    """Long rows (section, column_name, metric, value, label) of the named columns.

    A triple (section, metric, expression) gives a row of its own where the expression is not NULL.
    """
    nothing = F.lit(None).cast("string")
    record = lambda where, metric, value, text: F.struct(
        F.lit(where).alias("section"),
        F.col("column_name"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        text.alias("label"),
    )
    records = []
    for name in names:
        if isinstance(name, str):
            records.append(record(section, name, F.col(name), nothing if label is None else label))
        else:
            where, metric, value = name
            records.append(F.when(value.isNotNull(), record(where, metric, value, nothing)))
    return df.select(F.inline(F.filter(F.array(*records), lambda r: r.isNotNull())))


def profile_report(
    df: DataFrame,
    target: str,
    numeric: Sequence[str],
    text: Sequence[str] = ("title", "review_text"),
    categorical: Sequence[str] = (),
    missing_threshold: float = 0.3,
    k: int = 10,
    measured: bool = False,
    rating: str | None = None,
    age: str | None = None,
) -> DataFrame:
    """All profiles of a review table as one long table (section, column_name, metric, value, label).

    The table is read once: what the profiles need of a row (numbers, categories, text measures and a
    digest) is written as a narrow table, and every profile works on that. Where texts would travel through joins
    to get here, measure them first: with ``measured``, ``df`` has digests in place of its texts, and the columns of
    ``measure_texts`` of each text and of ``combined_text``.

    With ``rating`` and ``age`` the report has the mean target by rating, and by bins of age and of both text lengths.
    Absent text columns are reported as warnings.
    """
    absent = [c for c in text if c not in df.columns]
    text = [c for c in text if c in df.columns]
    names = [*text, *(["combined_text"] if len(text) == 2 else [])]
    columns = [c for c in df.columns if "__" not in c] if measured else df.columns
    if measured:
        measures = [F.col(f"{c}__{m}") for c in names for m in ("chars", "words", "missing", "blank")]
    else:
        texts = {c: F.col(c) for c in text}
        if len(text) == 2:
            texts["combined_text"] = combined_text(*texts.values())
        measures = [m.alias(name) for name, m in measure_texts(texts, "empty").items()]
    marked = [F.when(F.col(c).isNotNull(), F.lit(1)).alias(c) if c in text else F.col(c) for c in columns]
    df = df if not measured else df.select(*columns, *measures)
    narrow = materialize(df.select(*marked, *measures, F.unhex(row_digest(df.select(*columns))).alias("_digest")))
    # Texts are texts in the overview, whatever stands for them here.
    described = df.select(*[F.col(c).cast("string").alias(c) if c in text else F.col(c) for c in columns])
    numbers = number_profile(narrow, [target, *numeric]).withColumnRenamed("zero_share_all", "zero_share")
    count, missing = F.col("count"), F.col("missing_count")
    share = F.when(F.col("mostly_missing"), F.col("missing_share"))
    copies = duplicate_digests(narrow, "_digest").withColumn("column_name", F.lit("*"))
    pairs = corr_matrix(narrow, [*numeric, target]).withColumnRenamed("col_a", "column_name")
    parts = [
        _metrics(overview(described, narrow), "overview", ["row_count"], F.col("data_type")),
        _metrics(copies, "overview", ["duplicate_rows"]),
        _metrics(
            missing_profile(narrow.select(*columns), missing_threshold),
            "missing",
            ["missing_count", "missing_share", ("warning", "mostly_missing_share", share)],
        ),
        _metrics(
            numbers.filter(F.col("column_name") == target),
            "target",
            [
                *SPREAD,
                "zero_count",
                "zero_share",
                "skewness",
                ("warning", "target_without_numbers", F.when(count == 0, missing)),
                ("warning", "target_missing", F.when((count > 0) & (missing > 0), missing)),
            ],
        ),
        _metrics(numbers.filter(F.col("column_name") != target), "numeric", SPREAD),
        _metrics(measured_text_profile(narrow, names), "text", ["missing_count", "blank_count", *_LENGTHS]),
        _metrics(pairs, "correlation", ["corr"], F.col("col_b")),
    ]
    if categorical:
        values = category_profile(narrow, categorical, k)
        first = lambda c: F.when(F.col("value_rank") == 1, F.col(c))
        totals = [("category", c, first(c)) for c in ("distinct_count", "missing_count")]
        parts.append(_metrics(values, "category", ["value_count", *totals], F.coalesce("value", F.lit("<missing>"))))
    if rating:
        means = narrow.filter(F.col(rating).isNotNull()).groupBy(rating).agg(F.avg(target).alias("mean_target"), F.count("*").alias("row_count"))
        named = means.select(F.lit(rating).alias("column_name"), "mean_target", "row_count", F.col(rating).cast("string").alias("of"))
        parts.append(_metrics(named, "target_relation", ["mean_target", "row_count"], F.col("of")))
    for source, name in [(age, "age"), *[(f"{c}__chars", f"{c}_chars") for c in text]]:
        if source and age:
            bins = binned_mean(narrow, source, target).select(
                F.lit(name).alias("column_name"), F.col("mean").alias("mean_target"), F.col("row_count"), F.col("bin").cast("string").alias("of")
            )
            parts.append(_metrics(bins, "target_relation", ["mean_target", "row_count"], F.col("of")))
    if absent:
        lost = df.sparkSession.createDataFrame([(c, 1.0) for c in absent], "column_name string, absent_column double")
        parts.append(_metrics(lost, "warning", ["absent_column"]))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
