from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from venuelens.operators import distribution as ds, grouped

PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75, "top": 0.999}


def check(df, rows):
    got = {r["g"]: r for r in grouped.group_quantiles(df, "g", "v", PROBS).collect()}
    values = {}
    for g, v in rows:
        if g is not None and v is not None:
            values.setdefault(g, []).append(v)
    assert set(got) == set(values)
    for g, v in values.items():
        assert got[g]["n"] == len(v)
        assert [got[g][c] for c in PROBS] == pytest.approx(np.quantile(v, list(PROBS.values())).tolist(), rel=1e-12), g


@pytest.mark.parametrize("small, grid", [(50_000, 200), (40, 200), (25, 4)])
def test_equal_to_numpy(spark, monkeypatch, small, grid):
    """Hot, flat, tied and tiny groups; with small buffers all but the tiny ones are searched, with a coarse grid in several passes."""
    monkeypatch.setattr(grouped, "SMALL", small)
    monkeypatch.setattr(grouped, "GRID", grid)
    rng = np.random.default_rng(1)
    rows = [("hot", float(x)) for x in rng.lognormal(0, 3, 3000)] + [("flat", 7.0)] * 400
    rows += [("ties", float(x)) for x in rng.integers(0, 4, 500)] + [("two", float(x)) for x in rng.choice([0.0, 1e300], 300)]
    rows += [("edge", float(x)) for x in range(small + 1)][:600] + [("one", 3.5), ("pair", 1.0), ("pair", 2.0), (None, 1.0), ("hot", None)]
    check(spark.createDataFrame(rows, "g string, v double").repartition(5), rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert grouped.group_quantiles(empty, "g", "v", PROBS).count() == 0 and ds.box_stats(empty, "g", "v").count() == 0


def test_very_many_groups(spark):
    """100,000 groups: fences reach the rows without a shuffle of the rows; only partial aggregates are exchanged."""
    df = spark.range(600_000).select((F.col("id") % 100_000).alias("g"), (F.xxhash64("id") % 1000).cast("double").alias("v"))
    box = ds.box_stats(df, "g", "v")
    first = box.where("g = 77").first()
    own = [r["v"] for r in df.where("g = 77").collect()]
    q1, q3 = np.quantile(own, [0.25, 0.75])
    assert (first["n"], first["q1"], first["q3"]) == (6, pytest.approx(q1), pytest.approx(q3))
    assert first["outliers"] == sum(not q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1) for x in own)
    assert box.count() == 100_000
    plan = plan_of(box)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("BroadcastHashJoin")[-1]
