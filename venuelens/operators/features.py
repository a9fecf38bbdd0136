"""Review features, split, imputation, scaling and TF-IDF (SC-9 to SC-14, MD-1 to MD-7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from venuelens.functions import text as tx
from venuelens.operators import heavy
from venuelens.operators.quantiles import column_quantiles


def add_text_features(
    df: DataFrame,
    fit_words: Sequence[str] = tx.FIT_WORDS,
    quality_words: Sequence[str] = tx.QUALITY_WORDS,
    size_words: Sequence[str] = tx.SIZE_WORDS,
) -> DataFrame:
    """Combined text, lengths, presence flags and keyword features of title and review text."""
    title, body = tx.text_or_empty(F.col("title")), tx.text_or_empty(F.col("review_text"))
    both = F.col("combined_text")
    return df.withColumn("combined_text", tx.combined_text(title, body)).withColumns(
        {
            "review_text_len_chars": tx.char_count(body),
            "review_text_word_count": tx.word_count(body),
            "title_len_chars": tx.char_count(title),
            "title_word_count": tx.word_count(title),
            "has_title": tx.has_text(title),
            "has_review_text": tx.has_text(body),
            "fit_keyword_count": tx.keyword_count(both, fit_words),
            "quality_keyword_count": tx.keyword_count(both, quality_words),
            "size_keyword_flag": tx.keyword_flag(both, size_words),
        }
    )


def add_rating_flags(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Low (at most 2) and high (at least 4) rating; a missing rating is neither."""
    flag = lambda test: F.coalesce(test.cast("int"), F.lit(0))
    return df.withColumns(
        {"rating_is_low": flag(F.col(rating) <= 2), "rating_is_high": flag(F.col(rating) >= 4)}
    )


def split_point(key: str, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key and the seed only, the same in any SQL engine."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the same key always lands on the same side, whatever the partitioning."""
    test = split_point(key, seed) < test_share
    return df.filter(~test), df.filter(test)


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact median per column; 0 for a column without values."""
    found = column_quantiles(df.select(*cols), cols, {"median": 0.5})
    return {c: 0.0 if found[c]["median"] is None else found[c]["median"] for c in cols}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def fit_scaling(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column keeps deviation 1."""
    row = df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in cols], *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std") for c in cols]
    ).first()
    return {c: (row[f"{c}__mean"], row[f"{c}__std"] or 1.0) for c in cols}


def scale(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in scaling.items()})


def tfidf_vocabulary(df: DataFrame, col: str, size: int = 500, min_df: int = 2) -> DataFrame:
    """The most frequent terms found in at least ``min_df`` texts: term, total and document count, idf.

    Sorting the tokens of a text marks the first of each term, so that both counts come from one
    aggregation by term. Ties go to the smaller term. Only candidates from a summary of bounded size are counted, where the last
    count proves that no other term can be among the most frequent ones; else all terms are.
    """
    spark = df.sparkSession
    ordered = F.sort_array(tx.tokens(F.col(col)))
    marked = F.transform(
        F.col("_tokens"),
        lambda term, i: F.struct(
            term.alias("term"), F.when((i > 0) & (F.get(F.col("_tokens"), i - 1) == term), 0).otherwise(1).alias("new")
        ),
    )
    texts = df.agg(F.count("*").alias("texts")).first()["texts"]
    terms = df.select(ordered.alias("_tokens")).select(F.inline(marked))

    def best(rows: DataFrame) -> DataFrame:
        return (
            rows.groupBy("term")
            .agg(F.count("*").alias("term_count"), F.sum("new").alias("doc_count"))
            .filter(F.col("doc_count") >= min_df)
            .withColumn("idf", F.log(F.lit(1.0 + texts) / (1.0 + F.col("doc_count"))) + 1.0)
            .orderBy(F.desc("term_count"), "term")
            .limit(size)
        )

    for tracked in heavy.TRACKED:
        found, bound = heavy.candidates(df.select(F.explode(tx.tokens(F.col(col))).alias("term")), "term", 4 * size, tracked)
        top = best(heavy.among(terms, "term", found))
        rows = top.collect()  # at most ``size``
        if bound < 1 or (len(rows) == size and rows[-1]["term_count"] > bound):
            return spark.createDataFrame(rows, top.schema)
    return best(terms)
