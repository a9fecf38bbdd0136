from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from venuelens.functions import arrays as ar, numbers as nm, text as tx


def values(spark, rows, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def test_to_number_takes_numbers_only(spark):
    rows = ["1", "x", " 2 ", "1e3", "nan", "inf", "", None, "1d", "0x1p3", ".5", "-3.", "4,5"]
    expected = [1.0, None, 2.0, 1000.0, None, float("inf"), None, None, None, None, 0.5, -3.0, None]
    assert values(spark, rows, nm.to_number) == expected


def test_decimal_comma(spark):
    assert values(spark, ["4,5", "N/A", "x", "3", None], nm.decimal_comma) == [4.5, None, None, 3.0, None]


def test_digits_to_int(spark):
    assert values(spark, ["1 234 reviews", "(56)", "none", "", None], nm.digits_to_int) == [1234, 56, None, None, None]


def test_na_tokens(spark):
    assert values(spark, ["N/A", "", "nan", "NULL", "ok", None], nm.na_to_null) == [None, None, None, None, "ok", None]


def test_target_scale(spark):
    assert values(spark, [0.0, 3.0, None], lambda c: F.round(nm.unlog_target(nm.log_target(c)), 9), "double") == [0.0, 3.0, None]
    assert values(spark, [-2.0], nm.unlog_target, "double") == [0.0]


TRICKY = ["", " \t\n", "a b c  d", "  été déjà \t", None]


def test_word_count_sees_every_white_space(spark):
    assert values(spark, TRICKY, tx.word_count) == [0, 0, 4, 2, None]


def test_strip_and_flags(spark):
    assert values(spark, TRICKY, tx.strip) == ["", "", "a b c  d", "été déjà", None]
    assert values(spark, TRICKY, tx.has_text) == [0, 0, 1, 1, 0]
    assert values(spark, TRICKY, tx.is_blank) == [True, True, False, False, None]


def test_keyword_count_matches_whole_words(spark):
    rows = ["fits fit, small-fit éfit fit_ fitting", "FIT", "", None, "outfit"]
    assert values(spark, rows, lambda c: tx.keyword_count(c, ["fit"])) == [2, 1, 0, 0, 0]
    assert values(spark, rows, lambda c: tx.keyword_count(c, tx.FIT_WORDS)) == [5, 1, 0, 0, 0]
    assert values(spark, rows, lambda c: tx.keyword_flag(c, ["small"])) == [1, 0, 0, 0, 0]


def test_keyword_list_must_not_be_empty():
    with pytest.raises(ValueError):
        tx.words_pattern([])


def test_combined_text(spark):
    df = spark.createDataFrame([(" A ", "b\n"), (None, " x "), ("t", None), (None, None)], "a string, b string")
    rows = df.select(tx.combined_text(F.col("a"), F.col("b")).alias("c")).collect()
    assert sorted(r["c"] for r in rows) == ["", "A b", "t", "x"]


def test_tokens_have_two_characters(spark):
    assert values(spark, ["A bc, d_e été I", None], tx.tokens) == [["bc", "d_e", "été"], []]


def test_lists(spark):
    assert values(spark, ["a, b", "", None, "a,b"], ar.split_list) == [["a", "b"], [""], None, ["a,b"]]
    assert values(spark, ["['A', \"B's\"]", "[]"], ar.parse_list_text) == [["A", '"Bs"'], [""]]


def test_occurrences_and_sparse_counts(spark):
    rows = [["a", "b", "a"], [], None, ["c", None]]
    assert values(spark, rows, lambda c: ar.occurrences(c, "a"), "array<string>") == [2, 0, 0, 0]
    assert values(spark, rows, ar.value_counts_map, "array<string>") == [{"a": 2, "b": 1}, {}, None, {"c": 1}]


def test_struct_field(spark):
    df = spark.createDataFrame([([("x", "X"), ("y", "Y")],), ([],), (None,)], "c array<struct<alias:string,title:string>>")
    assert [r["t"] for r in df.select(ar.struct_field(F.col("c"), "title").alias("t")).collect()] == [["X", "Y"], [], None]


def test_price_bounds(spark):
    rows = ["$$ - $$$", "$", "$$-$$$$", "", "?", None]
    low = values(spark, rows, lambda c: ar.price_bounds(c)[0])
    high = values(spark, rows, lambda c: ar.price_bounds(c)[1])
    assert low == [2, 1, 2, None, None, None]
    assert high == [3, 1, 4, None, None, None]
    assert values(spark, ["$$", "", None], ar.price_length) == [2, 0, 0]
