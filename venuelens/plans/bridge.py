"""Views that give the supplied tables the shape of reviews and venues.

The text of each view is valid in Spark SQL and in other SQL engines; ``{name}`` stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from venuelens.functions.text import char_count, combined_text, text_or_empty
from venuelens.operators.profile import measure_texts

# Titles and texts alone, for the text operators: no join is needed to measure texts.
REVIEW_TEXTS = """
SELECT doc_id AS row_id,
 CASE WHEN doc_id % 6 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
 CASE WHEN doc_id % 28 = 0 THEN NULL ELSE text END AS review_text
FROM {documents}
"""

_REVIEW_HEAD = "SELECT d.doc_id AS row_id, e.user_id AS clothing_id, 18 + (e.user_id * 7) % 82 AS age,"
_REVIEW_TEXT = """
 CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE split_part(d.text, chr(10), 1) END AS title,
 CASE WHEN d.doc_id % 28 = 0 THEN NULL ELSE d.text END AS review_text,"""
_REVIEW_REST = """
 CAST(CASE l.quality WHEN 1 THEN 5 WHEN 0 THEN 2 END AS BIGINT) AS rating,
 CAST(1 - l.toxic AS BIGINT) AS recommended_ind,
 CAST(floor(e.value / 30) AS BIGINT) AS positive_feedback_count,
 d.lang AS division_name, e.event_type AS department_name,
 CASE WHEN d.doc_id % 97 = 0 THEN NULL ELSE d.source END AS class_name
FROM {documents} d JOIN {events} e ON e.event_id = d.doc_id LEFT JOIN {labels} l ON l.doc_id = d.doc_id
"""

REVIEWS = _REVIEW_HEAD + _REVIEW_TEXT + _REVIEW_REST

RESTAURANTS = """
SELECT p_partkey AS restaurant_id, p_name AS name,
 CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size / 10.0 AS DOUBLE) END AS rating,
 p_partkey % 50 AS reviews_count, replace(p_name, ' ', ', ') AS cuisine_type,
 CASE p_partkey % 5 WHEN 1 THEN '$' WHEN 2 THEN '$$ - $$$' WHEN 3 THEN '$$$$' WHEN 4 THEN '$$-$$$' END AS price,
 p_type = 'PROMO' AS is_sponsored
FROM {part}
"""

VIEWS = {"review_texts": REVIEW_TEXTS, "reviews": REVIEWS, "restaurants": RESTAURANTS}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _view(spark: SparkSession, folder: str, text: str, **given: DataFrame) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{name: given[name] if name in given else table(spark, folder, name) for name in names})


def review_texts(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, REVIEW_TEXTS)


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, REVIEWS)


def measured_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews whose texts were measured where they were read, before any join.

    In place of a text, ``title`` and ``review_text`` hold its digest (NULL for a missing text), so rows can be counted,
    compared and checked for missing values. ``measure_texts`` of both texts and of ``combined_text`` stand next to them.
    """
    texts = review_texts(spark, folder)
    columns = {"title": F.col("title"), "review_text": F.col("review_text")}
    columns["combined_text"] = combined_text(*columns.values())
    measures = measure_texts(columns, "empty")
    narrow = texts.select(
        "row_id",
        *[F.unhex(F.sha2(F.col(c), 256)).alias(f"{c}_digest") for c in ("title", "review_text")],
        *[m.alias(name) for name, m in measures.items()],
    )
    joined = narrow_reviews(spark, folder).join(narrow, "row_id")
    return joined.select(
        "row_id", "clothing_id", "age", F.col("title_digest").alias("title"), F.col("review_text_digest").alias("review_text"),
        "rating", "recommended_ind", "positive_feedback_count", "division_name", "department_name", "class_name", *measures,
    )


def review_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, chars): characters of each review text, 0 for a missing one; no join is needed to tell."""
    return review_texts(spark, folder).select("row_id", char_count(text_or_empty(F.col("review_text"))).alias("chars"))


def narrow_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews without their texts."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return _view(spark, folder, _REVIEW_HEAD + _REVIEW_REST, documents=documents)


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, RESTAURANTS)
