"""Global ranks and quantiles against numpy and pandas, whatever the skew and the partitioning."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from venuelens.operators import evaluate as ev, quantiles as qt, ranking as rk


def frame(spark, values, groups=None, partitions=4):
    rows = [(i, None if v is None else float(v), "g" if groups is None else groups[i]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, v double, g string").repartition(partitions)


def skewed(n, seed):
    """A third of the rows share one value, another third holds five values, the rest is continuous."""
    rng = np.random.default_rng(seed)
    parts = [np.full(n // 3, 7.0), rng.integers(0, 5, n // 3).astype(float), rng.normal(5, 4, n - 2 * (n // 3))]
    values = np.concatenate(parts)
    rng.shuffle(values)
    return values


def expected_ranks(values):
    s = pd.Series(values, dtype=float)
    return pd.DataFrame(
        {
            "id": range(len(s)),
            "predicted_rank": s.rank(method="min", ascending=False),
            "predicted_percentile": s.rank(pct=True),
        }
    )


@pytest.mark.parametrize("partitions", [1, 4, 17])
@pytest.mark.parametrize("parts", [1, 2, 16, 100])
def test_ranks_equal_pandas(spark, partitions, parts):
    values = skewed(900, parts)
    got = rk.add_predicted_ranks(frame(spark, values, partitions=partitions), "v", "id", parts).toPandas()
    merged = got.merge(expected_ranks(values), on="id", suffixes=("", "_x"))
    assert (merged.predicted_rank == merged.predicted_rank_x).all()
    assert np.allclose(merged.predicted_percentile, merged.predicted_percentile_x)


@pytest.mark.parametrize("values", [[3], [2, 2, 2], [1, 2, 2, 5], [1, None, 2, None, 2], list(range(50))])
def test_small_and_tied_ranks(spark, values):
    got = rk.add_predicted_ranks(frame(spark, values), "v", "id").toPandas().merge(expected_ranks(values), on="id", suffixes=("", "_x"))
    assert np.allclose(got.predicted_rank.astype(float), got.predicted_rank_x, equal_nan=True)
    assert np.allclose(got.predicted_percentile.astype(float), got.predicted_percentile_x, equal_nan=True)


def test_ordinal_ranks_break_ties_by_key_in_groups(spark):
    values = skewed(600, 3)
    groups = ["hot" if i % 3 else f"g{i % 7}" for i in range(600)]
    got = rk.add_positions(frame(spark, values, groups), "v", "id", ["g"], 16).toPandas()
    frame_ = pd.DataFrame({"id": range(600), "v": values, "g": groups}).sort_values(["g", "v", "id"])
    frame_["ordinal"] = frame_.groupby("g").cumcount() + 1
    frame_["n"] = frame_.groupby("g").v.transform("size")
    merged = got.merge(frame_[["id", "ordinal", "n"]], on="id")
    assert (merged.rank_ordinal == merged.ordinal).all()
    assert (merged.rank_n == merged.n).all()


def test_a_frequent_value_is_spread_over_cells(spark):
    cells = rk.ordered_cells(frame(spark, [1.0] * 3000), ["v", "id"], 16).groupBy("_cell").count()
    assert cells.count() == 16
    assert cells.agg(F.max("count")).first()[0] < 3000 / 8


@pytest.mark.parametrize("frequent", [60, 2000])
def test_cells_do_not_grow_with_frequent_values(spark, frequent):
    df = spark.range(6000).select("id", (F.col("id") % frequent).cast("double").alias("v"))
    assert rk.ordered_cells(df, ["v", "id"], 256).select("_cell").distinct().count() <= 256
    got = rk.add_positions(df, "v", "id", parts=64).toPandas()
    s = got.set_index("id").v
    assert np.allclose(got.set_index("id").rank_less + 1, s.rank(method="min"))
    assert np.allclose(got.set_index("id").rank_ties, s.groupby(s).transform("size"))


def test_text_keys_large_numbers_and_decimals(spark):
    values = [2**53 + (i % 3) for i in range(90)]
    df = spark.createDataFrame([(f"k{i:03d}", v) for i, v in enumerate(values)], "k string, v long")
    want = pd.DataFrame({"k": [f"k{i:03d}" for i in range(90)], "v": values}).sort_values(["v", "k"]).k.tolist()
    for kind in ("bigint", "decimal(20,0)"):
        rows = rk.add_positions(df.withColumn("v", F.col("v").cast(kind)), "v", "k", parts=7).orderBy("rank_ordinal").collect()
        assert [r.k for r in rows] == want
        assert {(int(r.v) - 2**53, r.rank_less, r.rank_ties) for r in rows} == {(0, 0, 30), (1, 30, 30), (2, 60, 30)}


@pytest.mark.parametrize("n", [1, 9, 10, 25, 400])
def test_top_decile_breaks_ties_at_the_cut_by_key(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(k), float(v)) for k, v in zip(rng.permutation(n) * (2**33) - 2**40, rng.integers(0, 4, n))]
    df = spark.createDataFrame([*rows, (1, None)], "k long, v double")
    want = sorted(rows, key=lambda r: (r[1], r[0]))[-max(1, n // 10) :]
    assert sorted(map(tuple, rk.top_decile(df, "v", "k").collect())) == sorted(want)
    assert "Window" not in plan_of(rk.top_decile(df, "v", "k"))


def test_row_level_plan_has_one_shuffle_of_the_rows(spark):
    plan = plan_of(rk.add_predicted_ranks(frame(spark, range(100), partitions=4), "v", "id"))
    row_side = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in row_side
    assert row_side.count("Exchange hashpartitioning") == 1
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("few", [50_000, 20, 1])
def test_top_decile_of_text_keys(spark, monkeypatch, few):
    monkeypatch.setattr(rk, "FEW", few)
    rng = np.random.default_rng(4)
    keys = {"".join(rng.choice(list("aZ-_9é\U0001f355"), rng.integers(0, 9))) for _ in range(900)}
    rows = [(float(rng.integers(0, 3)), k, 1) for k in keys] + [(None, "zz", 1)]
    df = spark.createDataFrame(rows, "v double, k string, _key int")
    for part in (df, df.filter("v = 1"), df.limit(0)):
        known = [tuple(r) for r in part.filter("v is not null").collect()]
        want = sorted(known, key=lambda r: (r[0], r[1].encode()))[len(known) - max(1, len(known) // 10) :] if known else []
        got = sorted(map(tuple, rk.top_decile(part, "v", "k").collect()), key=lambda r: (r[0], r[1].encode()))
        assert got == want


def test_rank_correlation_and_top_decile(spark):
    rng = np.random.default_rng(5)
    actual, score = rng.integers(0, 4, 400), np.round(rng.normal(size=400), 1)
    df = spark.createDataFrame(
        [(i, float(a), float(s)) for i, (a, s) in enumerate(zip(actual, score))], "id long, y double, p double"
    )
    order = lambda a: np.lexsort((np.arange(400), a)).argsort()
    d = order(actual) - order(score)
    expected = 1 - 6 * np.sum(d.astype(float) ** 2) / (400 * (400**2 - 1))
    assert ev.rank_correlation(df, "y", "p", "id").first()[0] == pytest.approx(expected)
    top = np.lexsort((np.arange(400), score))[-40:]
    assert ev.top_decile_rate(df, "y", "p", "id").first()[0] == pytest.approx((actual[top] > 0).mean())


def test_metrics_of_constant_sides_are_null(spark):
    df = spark.createDataFrame([(i, 2.0, float(i)) for i in range(20)], "id long, y double, p double")
    assert ev.rank_correlation(df, "y", "p", "id").first()[0] is None
    row = ev.regression_metrics(df, "y", "p").first()
    assert row["r2"] is None and row["rmse"] > 0


PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}


def check_quantiles(got, values):
    clean = np.array([v for v in values if v is not None], dtype=float)
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(np.quantile(clean, p)), (name, len(clean))


@pytest.mark.parametrize("values", [[4], [1, 2, 3, 10], [5] * 9, [None, 1, None, 2], list(range(101)), skewed(999, 1)])
def test_quantiles_equal_numpy(spark, values):
    df = frame(spark, values)
    check_quantiles(qt.exact_quantiles(df, "v", PROBS, ["g"], parts=8).first(), values)
    check_quantiles(qt.column_quantiles(df, ["v"], PROBS)["v"], values)


@pytest.mark.parametrize("small", [1, 3, 40])
def test_searched_quantiles_equal_numpy(spark, monkeypatch, small):
    monkeypatch.setattr(qt, "SMALL", small)
    for values in (skewed(3000, 2), np.repeat([0.0, 1.0], [2000, 1500]), np.random.default_rng(0).lognormal(0, 3, 2500)):
        check_quantiles(qt.column_quantiles(frame(spark, values), ["v"], PROBS)["v"], values)


def test_quantiles_per_group_with_a_hot_group(spark):
    values = skewed(1200, 9)
    groups = ["hot" if i % 3 else f"g{i % 5}" for i in range(1200)]
    got = qt.exact_quantiles(frame(spark, values, groups), "v", PROBS, ["g"], parts=16).collect()
    for row in got:
        check_quantiles(row, [v for v, g in zip(values, groups) if g == row["g"]])
    assert len(got) == len(set(groups))


def test_quantiles_of_nothing(spark):
    df = frame(spark, [None, None])
    assert qt.column_quantiles(df, ["v"], {"m": 0.5}) == {"v": {"m": None}}
    assert qt.exact_quantiles(df, "v", {"m": 0.5}, ["g"]).count() == 0
