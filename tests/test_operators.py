"""Filters, duplicates, profiles, distributions, categories, encodings and matching on hand-made rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from venuelens.operators import categories as ct, dedup as dd, distribution as ds, encoding as en, filters as fl
from venuelens.operators import materialize as mt, matching, profile as pf


def test_junk_filter_keeps_null(spark):
    df = spark.createDataFrame([("Меню",), ("Итальянская",), (None,), ("Сейчас открыто",)], "c string")
    assert sorted(str(r[0]) for r in fl.drop_junk(df, "c").collect()) == ["None", "Итальянская"]


def test_reviewed_unrated_and_missing(spark):
    df = spark.createDataFrame([(0, None), (3, None), (2, 4.5), (None, None)], "n int, r double")
    assert fl.reviewed_unrated(df, "n", "r").collect() == [(3, None)]
    assert fl.drop_missing(df, ["n", "r"]).collect() == [(2, 4.5)]
    assert fl.count_where(df, F.col("n") == 0).first()[0] == 1


def test_valid_target_needs_enough_rows(spark):
    df = spark.createDataFrame([(i, i if i else None) for i in range(51)], "id int, t int")
    assert fl.valid_target(df, "t", 50).count() == 50
    with pytest.raises(ValueError):
        fl.valid_target(df, "t", 51)


def sized_categories(spark):
    rows = [(name, 1.0) for name, size in (("c9", 9), ("c10", 10), ("c20", 20), ("c21", 21)) for _ in range(size)]
    rows += [("unrated", None)] * 15 + [(None, 3.0)] * 2
    return spark.createDataFrame(rows, "c string, r double")


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_drop_rare_keeps_null_and_counts_only_values(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    kept = fl.drop_rare(sized_categories(spark), "c", "r", 10)
    assert {(r["c"], r["count"]) for r in kept.groupBy("c").count().collect()} == {
        ("c10", 10), ("c20", 20), ("c21", 21), (None, 2)
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_category_stats(spark):
    stats = {r["c"]: r for r in ct.category_stats(sized_categories(spark), "c", "r").collect()}
    assert set(stats) == {"c9", "c10", "c20", "c21", "unrated"}
    assert stats["unrated"]["count"] == 0 and stats["unrated"]["mean"] is None
    one = ct.category_stats(spark.createDataFrame([("a", 2.0)], "c string, r double"), "c", "r").first()
    assert one["std"] is None and one["count"] == 1


def test_top_and_tail_break_ties_by_value(spark):
    df = spark.createDataFrame([(c,) for c in "bbaaccd"] + [(None,)], "c string")
    for parts in (1, 4, 17):
        assert [r["c"] for r in ct.top_values(df.repartition(parts), "c", 2).collect()] == ["a", "b"]
        assert [r["c"] for r in ct.rarest_values(df.repartition(parts), "c", 2).collect()] == ["d", "a"]


def test_leakage(spark):
    df = spark.createDataFrame([(i, i * 2, (i * 7) % 5, 1) for i in range(20)], "t int, twice int, other int, const int")
    found = {r["feature"]: (r["corr"], r["leaks"]) for r in fl.leakage_check(df, "t", ["twice", "other", "const"]).collect()}
    assert found["twice"][1] and not found["other"][1] and found["const"] == (None, False)
    with pytest.raises(ValueError):
        fl.leakage_check(df, "t", ["t"])


def test_feature_types(spark):
    rows = [(i, float(i), f"d{i % 3}", f"c{i}", "text", i) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, age double, division_name string, class_name string, title string, t int")
    assert fl.feature_types(df, "t", ["row_id"]) == {"numeric": ["age"], "categorical": ["division_name"], "text": ["title"]}
    constant, cols = fl.with_constant_feature(df, [])
    assert cols == ["constant_feature"] and constant.select("constant_feature").distinct().count() == 1


ROWS = [(1, "a", None), (1, "a", None), (2, None, 0.0), (2, None, -0.0), (3, "x", 1.0), (None, "a", 1.0)]


def test_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame(ROWS, "i int, s string, d double")
    assert dd.duplicate_count(df).first()[0] == 2
    assert dd.drop_duplicate_rows(df).count() == 4
    assert dd.duplicate_count(df.limit(0)).first()[0] == 0
    moved = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert dd.duplicate_count(moved).first()[0] == 0
    assert dd.distinct_ids(df, "i").first()[0] == 4
    assert dd.distinct_ids(df.filter("i IS NOT NULL"), "i").first()[0] == 3


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_first_row_per_key(spark, partitions):
    rows = [(f"k{i % 5}" if i % 3 else "hot", i) for i in range(100)] + [(None, 500), (None, 400)]
    df = spark.createDataFrame(rows, "k string, o int").repartition(partitions)
    kept = dd.dedup_by_key(df, "k", [F.col("o")])
    expected = pd.DataFrame(rows, columns=["k", "o"]).groupby("k", dropna=False).o.min()
    assert sorted(r["o"] for r in kept.collect()) == sorted(expected)
    assert partitions == 1 or "row_number(), 1, Partial" in plan_of(kept)


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2.5, 2)], "b double, id int")
    assert sorted(map(tuple, dd.union_batches([a, b]).select("id", "a", "b").collect())) == [(1, "x", None), (2, None, 2.5)]


def test_missing_profile(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (None, 2.0, None), (3, 1.0, None)], "a int, b double, c string")
    rows = {r["column_name"]: (r["missing_count"], r["mostly_missing"]) for r in pf.missing_profile(df, 0.5).collect()}
    assert rows == {"a": (1, False), "b": (1, False), "c": (3, True)}


def test_numeric_and_target_profile_equal_pandas(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame({"a": rng.integers(0, 4, 200).astype(float), "b": rng.normal(size=200), "k": 5.0})
    data.loc[::9, "a"] = np.nan
    df = spark.createDataFrame(data)
    for row in pf.numeric_profile(df, ["a", "b", "k"]).collect():
        s = data[row["column_name"]]
        assert (row["count"], row["missing_count"]) == (s.count(), s.isna().sum())
        for name, want in (("min", s.min()), ("max", s.max()), ("mean", s.mean()), ("median", s.median()), ("std", s.std())):
            assert row[name] == pytest.approx(want)
    every, valid = (pf.target_profile(df, "a", mode).first() for mode in ("all", "valid"))
    assert every["skewness"] == pytest.approx(data.a.skew())
    assert every["zero_share"] == pytest.approx((data.a == 0).mean())
    assert valid["zero_share"] == pytest.approx((data.a == 0).sum() / data.a.count())
    approx = {r["column_name"]: r["median"] for r in pf.numeric_profile(df, ["a", "k"], approx=True).collect()}
    assert approx["k"] == 5.0


def test_profiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "t double")
    row = pf.target_profile(df, "t").first()
    assert row["count"] == 0 and row["median"] is None and row["skewness"] is None


def test_text_profile_modes(spark):
    df = spark.createDataFrame([("one two",), (" ",), (None,), ("été",)], "t string")
    drop, empty = (pf.text_profile(df, ["t"], mode).first() for mode in ("drop", "empty"))
    assert (drop["missing_count"], drop["blank_count"], drop["chars_min"], drop["chars_median"]) == (1, 1, 1, 3.0)
    assert (empty["missing_count"], empty["blank_count"], empty["chars_min"], empty["chars_median"]) == (1, 2, 0, 2.0)
    assert drop["words_max"] == 2 and drop["words_mean"] == pytest.approx(1.0)


def test_correlations(spark):
    data = pd.DataFrame({"a": [1.0, 2, 3, None], "b": [2.0, 1, 5, 6], "c": [1.0] * 4})
    got = {(r[0], r[1]): r[2] for r in pf.corr_matrix(spark.createDataFrame(data), ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(data.a.corr(data.b))
    assert got["a", "c"] is None and got["b", "c"] is None


def test_category_profile(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", "u"), (None, "v")], "a string, b string")
    kept = [tuple(r) for r in pf.category_profile(df, ["a", "b"], 2).orderBy("column_name", "value_rank").collect()]
    assert kept == [("a", 2, 1, 1, "x", 2), ("a", 2, 1, 2, "y", 1), ("b", 2, 2, 1, None, 2), ("b", 2, 2, 2, "u", 1)]
    dropped = pf.category_profile(df, ["b"], 5, keep_null=False)
    assert sorted(r["value"] for r in dropped.collect()) == ["u", "v"]


def test_report_warns(spark):
    df = spark.createDataFrame([(1, None, "t", None, 2.0), (2, 1, None, None, 3.0)], "id int, target int, title string, review_text string, n double")
    rows = {(r["section"], r["column_name"], r["metric"]): r["value"] for r in pf.profile_report(df, "target", ["n"]).collect()}
    assert rows["warning", "review_text", "mostly_missing_share"] == 1.0
    assert rows["warning", "target", "target_missing"] == 1.0
    assert rows["overview", "*", "duplicate_rows"] == 0.0


SHAPES = [[0.0, 10.0, 1.0, 1.0, 5.0, 9.999], [3.0, 3.0], [0.1 * i for i in range(101)], [-1.0, None, 4.0]]


@pytest.mark.parametrize("values", SHAPES)
@pytest.mark.parametrize("bins", [1, 7, 10])
def test_histogram_equals_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ds.histogram(df, "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram([v for v in values if v is not None], bins)
    assert [r["row_count"] for r in got] == counts.tolist()
    assert np.allclose([r["lower"] for r in got], edges[:-1])


@pytest.mark.parametrize("values", SHAPES)
@pytest.mark.parametrize("bins", [1, 7, 10])
def test_binned_mean_equals_cut(spark, values, bins):
    data = pd.DataFrame({"x": values, "y": range(len(values))}).astype(float)
    df = spark.createDataFrame([(x, float(y)) for y, x in enumerate(values)], "x double, y double")
    got = ds.binned_mean(df, "x", "y", bins).orderBy("bin").collect()
    clean = data.dropna()
    want = clean.groupby(pd.cut(clean.x, bins, labels=range(bins)), observed=False).y.mean()
    assert np.allclose([np.nan if r["mean"] is None else r["mean"] for r in got], want.to_numpy(), equal_nan=True)


def test_box_and_grid(spark):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 7.0), (None, 1.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    box = {r["g"]: r for r in ds.box_stats(df, "g", "v").collect()}
    assert set(box) == {"a", "b"}
    a, b = box["a"], box["b"]
    assert (a["n"], a["q1"], a["median"], a["q3"], a["whisker_low"], a["whisker_high"], a["outliers"]) == (5, 2, 3, 4, 1, 4, 1)
    assert (b["q1"], b["whisker_low"], b["whisker_high"], b["outliers"]) == (7, 7, 7, 0)
    grid = ds.scatter_grid(spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (1.0, None)], "x double, y double"), "x", "y", 2, 2)
    assert sorted(map(tuple, grid.collect())) == [(0, 0, 1), (1, 1, 1)]


def test_one_hot(spark):
    df = spark.createDataFrame([(1, ["p", "d", "p"]), (2, []), (3, None)], "id int, t array<string>")
    wide = en.one_hot_array(df, "t", ["d", "p"]).orderBy("id").collect()
    assert [(r["t_d"], r["t_p"]) for r in wide] == [(1, 2), (0, 0), (0, 0)]
    scalar = en.one_hot_scalar(spark.createDataFrame([("$",), (None,)], "p string"), "p", ["$", "$$"])
    assert sorted((r["$"], r["$$"]) for r in scalar.collect()) == [(0, 0), (1, 0)]


def test_sparse_counts_have_room_for_any_number_of_values(spark):
    rows = spark.range(5000).select(F.array(F.concat(F.lit("v"), F.col("id")), F.lit("all")).alias("t"))
    counts = en.sparse_counts(rows, "t").select(F.explode("value_counts")).groupBy("key").agg(F.sum("value").alias("n"))
    assert counts.count() == 5001 and counts.filter("key = 'all'").first()["n"] == 5000


def test_quantiles_of_infinite_values(spark):
    from venuelens.operators import quantiles as qt

    df = spark.createDataFrame([(float("inf"),), (float("inf"),), (1.0,)], "v double")
    assert qt.exact_quantiles(df, "v", {"m": 0.5}).first()["m"] == float("inf")
    assert qt.column_quantiles(df, ["v"], {"m": 0.5, "low": 0.0})["v"] == {"m": float("inf"), "low": 1.0}


def test_match_values(spark):
    df = spark.createDataFrame([("Intimates",), ("Initmates",), (" intimates ",), ("in-timates",), ("zzz",), (None,), ("",)], "v string")
    got = [tuple(r) for r in matching.match_values(df, "v", ["Dresses", "Intimates"], 0.6).collect()]
    assert [(g[1], g[2]) for g in got] == [
        ("Intimates", "exact"), ("Intimates", "closest"), ("Intimates", "normalised"), ("Intimates", "normalised"),
        (None, "none"), (None, "none"), (None, "none"),
    ]
    assert got[1][3] == pytest.approx(7 / 9)


def test_materialize(spark):
    df = spark.range(10).repartition(2)
    kept = mt.materialize(df)
    assert kept.count() == 10 and "FileScan parquet" in plan_of(kept)
