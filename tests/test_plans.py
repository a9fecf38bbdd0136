"""Physical plans of queries that must stay on the JVM and free of joins of everything with everything."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from tests.conftest import plan_of
from venuelens.operators import filters as fl
from venuelens.plans import bridge
from venuelens.plans.bridge import table

NATIVE = ["category_stats", "price_tiers", "text_features", "match_values", "rare_excluded", "tfidf_vocab", "histogram", "page_cards"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_plan(spark, sf, name):
    plan = plan_of(contract.queries()[name](spark, sf))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_top_k_takes_ordered_rows(spark, sf):
    assert "TakeOrderedAndProject" in plan_of(contract.queries()["popular_categories"](spark, sf))


def test_scan_reads_two_columns_and_filters(spark, sf):
    plan = plan_of(fl.drop_missing(table(spark, sf, "lineitem"), ["l_tax"]).filter("l_quantity > 49").select("l_quantity"))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert schema == "l_quantity:double,l_tax:double"
    assert "GreaterThan(l_quantity,49.0)" in plan


def test_text_features_move_no_rows_of_a_split_table(spark, sf, tmp_path):
    table(spark, sf, "documents").repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    assert "Exchange" not in plan_of(contract.queries()["text_features"](spark, str(tmp_path)))


def test_rare_categories_leave_by_anti_join(spark, sf):
    assert "LeftAnti" in plan_of(contract.queries()["rare_excluded"](spark, sf))


@pytest.mark.parametrize("view", ["measured_reviews", "narrow_reviews"])
def test_no_exchange_carries_a_text(spark, sf, view):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(getattr(bridge, view)(spark, sf)).split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(below) >= 3
    assert not any(re.search(r"(?<![\w(])text#\d+[,\]]|AS (title|review_text|combined_text)#", line) for line in below)
