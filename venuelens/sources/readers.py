"""Typed readers of review, venue and business files (SRC-1 to SRC-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from venuelens.functions.numbers import na_to_null, to_number
from venuelens.sources.records import parse_records, read_records

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("clothing_id", T.LongType()),
        T.StructField("age", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("rating", T.LongType()),
        T.StructField("recommended_ind", T.LongType()),
        T.StructField("positive_feedback_count", T.LongType()),
        T.StructField("division_name", T.StringType()),
        T.StructField("department_name", T.StringType()),
        T.StructField("class_name", T.StringType()),
    ]
)

RESTAURANT_SCHEMA = T.StructType(
    [
        T.StructField("rating", T.StringType()),
        T.StructField("reviews_count", T.LongType()),
        T.StructField("cuisine_type", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("is_sponsored", T.BooleanType()),
    ]
)

BUSINESS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("is_closed", T.BooleanType()),
        T.StructField("review_count", T.LongType()),
        T.StructField(
            "categories",
            T.ArrayType(T.StructType([T.StructField("alias", T.StringType()), T.StructField("title", T.StringType())])),
        ),
        T.StructField("rating", T.DoubleType()),
        T.StructField("transactions", T.ArrayType(T.StringType())),
        T.StructField("price", T.StringType()),
    ]
)


def _typed(c: Column, kind: T.DataType) -> Column:
    value = na_to_null(c)
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.DoubleType):
        return to_number(value)
    if isinstance(kind, T.LongType):
        number = to_number(value)
        # "5.0" is how an integer column with gaps is written; 5.5 is no integer.
        return F.coalesce(F.trim(value).try_cast("bigint"), F.when(number == F.floor(number), number).try_cast("bigint"))
    return F.trim(value).try_cast(kind)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """CSV with a header, columns by position, missing-value tokens as NULL.

    ``multi_line`` allows line breaks in quoted text. Files are read in blocks by many tasks either way; with it the records
    are cut in two passes and kept in Parquet (see ``records``), so switch it off for files without such breaks.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    if multi_line:
        raw = parse_records(read_records(spark, path), schema)
    else:
        raw = spark.read.schema(texts).csv(path, header=True, quote='"', escape='"')
    return raw.select(*[_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def read_reviews(
    spark: SparkSession, path: str, schema: T.StructType = REVIEW_SCHEMA, multi_line: bool = True
) -> DataFrame:
    """Review files; their texts may hold line breaks."""
    return read_csv(spark, path, schema, multi_line)


def read_restaurants(
    spark: SparkSession, path: str, schema: T.StructType = RESTAURANT_SCHEMA, multi_line: bool = False
) -> DataFrame:
    """Venue files; no field holds a line break, so large files are split over tasks."""
    return read_csv(spark, path, schema, multi_line)


def parse_csv(df: DataFrame, col: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """Parse a column of CSV lines and put its typed fields next to the other columns.

    Missing-value tokens and unreadable numbers become NULL, as in the file readers.
    """
    kept = [c for c in df.columns if c != col]
    texts = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    parsed = df.select(*kept, F.from_csv(F.col(col), texts, {"sep": separator, "quote": '"', "escape": '"'}).alias("_csv"))
    return parsed.select(*kept, *[_typed(F.col("_csv")[f.name], f.dataType).alias(f.name) for f in schema.fields])


def read_businesses(spark: SparkSession, path: str) -> DataFrame:
    """One row per business of all JSON responses in a folder."""
    response = T.StructType([T.StructField("businesses", T.ArrayType(BUSINESS_SCHEMA))])
    return spark.read.schema(response).json(path, multiLine=True).select(F.inline("businesses"))


def parse_responses(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Parse a JSON text column and put its fields next to the other columns."""
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, F.from_json(col, schema).alias("_json")).select(*kept, "_json.*")
