from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from venuelens.operators import features as ft, heavy


def plain(df, k):
    rows = df.where("v is not null").groupBy("v").count().orderBy(F.desc("count"), "v").limit(k).collect()
    return [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def steep(spark):
    """Half of the rows are few values, the others nearly all different; ties at every place."""
    x = F.col("id")
    value = F.when(x % 2 == 0, F.concat(F.lit("hot"), F.floor(F.log2(x % 4096 + 1)))).when(x % 101 == 1, None).otherwise(F.concat(F.lit("v"), x))
    return spark.range(60_000).select(value.alias("v"), x)


@pytest.mark.parametrize("k", [1, 5, 12, 20])
def test_top_counts_are_exact(spark, steep, monkeypatch, k):
    for tracked in ((1 << 16,), (2000,), (128, 512), (96,)):
        monkeypatch.setattr(heavy, "TRACKED", tracked)
        assert [tuple(r) for r in heavy.top_counts(steep, "v", k).collect()] == plain(steep, k)


def test_flat_and_odd_columns(spark, monkeypatch):
    monkeypatch.setattr(heavy, "TRACKED", (128, 256))
    flat = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("v"))
    assert [tuple(r) for r in heavy.top_counts(flat, "v", 7).collect()] == plain(flat, 7)
    few = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("",)], "v string")
    assert [tuple(r) for r in heavy.top_counts(few, "v", 9).collect()] == [("a", 2), ("", 1), ("b", 1)]
    assert heavy.top_counts(few.limit(0), "v", 3).count() == 0


def test_other_values_stay_below_the_bound(steep):
    for k, tracked in ((5, 64), (3, 4096), (40, 64)):
        values, bound = heavy.candidates(steep, "v", k, tracked)
        rest = steep.where("v is not null").where(~F.col("v").isin(values)).groupBy("v").count().agg(F.max("count")).first()[0]
        assert len(values) <= k and rest <= bound < steep.count()


def test_frequent_terms_leave_the_others_out_of_the_shuffle(spark, steep, monkeypatch):
    texts = steep.select(F.concat_ws(" ", "v", F.lit("common word")).alias("text"))
    monkeypatch.setattr(heavy, "TRACKED", ())
    want = ft.tfidf_vocabulary(texts, "text", 9, 2).collect()
    monkeypatch.setattr(heavy, "TRACKED", (4096,))
    aggregated = []
    true_among = heavy.among
    monkeypatch.setattr(heavy, "among", lambda df, col, values: aggregated.append(true_among(df, col, values)) or aggregated[-1])
    assert ft.tfidf_vocabulary(texts, "text", 9, 2).collect() == want
    assert aggregated[0].select("term").distinct().count() <= 36
