"""The venue market studies: scraped listings and API listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from venuelens.functions.arrays import parse_list_text, price_bounds, price_length, split_list, struct_field
from venuelens.functions.numbers import decimal_comma
from venuelens.operators import categories as ct, dedup as dd, distribution as ds, encoding as en, filters as fl
from venuelens.operators.materialize import materialize
from venuelens.operators.profile import corr_matrix

PRICE_SIGNS = ("$", "$$", "$$$", "$$$$")


def clean_listings(scraped: DataFrame) -> DataFrame:
    """Scraped rows to typed, priced, distinct venues with a cuisine list."""
    rated = fl.drop_missing(
        scraped.withColumn("rating", decimal_comma(F.col("rating"))), ["rating", "price", "cuisine_type"]
    )
    low, high = price_bounds(F.col("price"))
    priced = rated.withColumns({"min_price": low, "max_price": high})
    kept = dd.drop_duplicate_rows(fl.drop_junk(priced, "cuisine_type"))
    return kept.withColumn("cuisine_type", split_list(F.col("cuisine_type")))


def listing_study(scraped: DataFrame, min_count: int = 10) -> dict[str, DataFrame]:
    """All tables of the scraped-venue study by name."""
    venues = materialize(clean_listings(scraped))
    exploded = ct.explode_values(venues, "cuisine_type")
    stats = ct.category_stats(exploded, "cuisine_type", "rating").filter(F.col("count") >= min_count)
    frequent = fl.drop_rare(exploded, "cuisine_type", "rating", min_count)
    by_price = ct.mean_by(venues, ["min_price", "max_price"], "rating", "rating")
    return {
        "cuisine_stats": stats,
        "best_rated": ct.top_k(stats, F.col("mean"), ["cuisine_type"], 10),
        "most_rated": ct.top_k(stats, F.col("count"), ["cuisine_type"], 10),
        "frequent_cuisines": ct.top_values(frequent, "cuisine_type", 15),
        "rarest_kept_cuisines": ct.rarest_values(frequent, "cuisine_type", 10),
        "most_reviewed": ct.top_k(venues, F.col("reviews_count"), ["cuisine_type", "rating", "price", "is_sponsored"], 10),
        "rating_histogram": ds.histogram(venues, "rating"),
        "reviews_histogram": ds.histogram(venues, "reviews_count"),
        "rating_by_price": by_price,
        "price_correlation": corr_matrix(by_price, ["min_price", "max_price", "rating"]),
        "rating_box_by_price": ds.box_stats(venues, "min_price", "rating"),
        "rating_box_by_sponsored": ds.box_stats(venues, "is_sponsored", "rating"),
        "reviews_rating_grid": ds.scatter_grid(venues, "reviews_count", "rating"),
    }


def encode_businesses(
    batches: list[DataFrame], transactions: Sequence[str] | None = None, categories: Sequence[str] | None = None
) -> DataFrame:
    """API responses to one row per business with counts of transactions and categories and flags of the price.

    Listed values get a column each; without a list the counts are a map per row, ``<column>_counts``, which has room for
    any number of values.
    """
    rows = dd.union_batches(batches).withColumn("categories", struct_field(F.col("categories"), "title"))
    distinct = dd.dedup_by_key(
        rows, "id", [F.col("review_count").desc(), F.to_json(F.struct("*"))]
    ).select("id", "name", "is_closed", "review_count", "categories", "rating", "transactions", "price")
    for col, values in (("transactions", transactions), ("categories", categories)):
        wide = en.sparse_counts(distinct, col, f"{col}_counts") if values is None else en.one_hot_array(distinct, col, values)
        distinct = wide
    return en.one_hot_scalar(distinct, "price", PRICE_SIGNS)


def business_study(listed: DataFrame, min_count: int = 10, popular_count: int = 20) -> dict[str, DataFrame]:
    """All tables of the API-venue study; ``categories`` is the text of a list."""
    venues = materialize(fl.fill_missing(listed, {"price": ""}).withColumn("categories", parse_list_text(F.col("categories"))))
    exploded = ct.explode_values(venues, "categories")
    stats = ct.category_stats(exploded, "categories", "rating")
    frequent = fl.drop_rare(exploded, "categories", "rating", min_count)
    leveled = venues.withColumn("price_category", price_length(F.col("price")))
    by_price = ct.mean_by(leveled, ["price_category"], "rating", "rating").filter("price_category <> 0")
    return {
        "category_stats": stats,
        "best_rated": ct.top_k(stats.filter(F.col("count") > popular_count), F.col("mean"), ["categories"], 10),
        "most_rated": ct.top_k(stats, F.col("count"), ["categories"], 10),
        "frequent_categories": ct.top_values(frequent, "categories", 15),
        "rarest_kept_categories": ct.rarest_values(frequent, "categories", 20),
        "most_reviewed": ct.top_k(venues, F.col("review_count"), ["id"], 10).select(
            "name", "review_count", "categories", "rating", "transactions", "price"
        ),
        "rating_histogram": ds.histogram(venues, "rating"),
        "reviews_histogram": ds.histogram(venues, "review_count"),
        "reviews_rating_grid": ds.scatter_grid(venues, "review_count", "rating"),
        "rating_by_price": by_price,
        "price_correlation": corr_matrix(by_price, ["price_category", "rating"]),
        "rating_box_by_price": ds.box_stats(leveled, "price_category", "rating"),
    }
