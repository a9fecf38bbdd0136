from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tests.conftest import plan_of
from venuelens.operators import gram, profile as pf


def frame(k, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) * 10.0 ** rng.integers(-3, 6, k) + 10.0 ** rng.integers(0, 6, k)
    x[rng.random((n, k)) < 0.2] = np.nan
    x[:, 3], x[:, 4] = 0.1, np.nan
    x[: n // 2, 5] = np.nan
    x[n // 2 :, 6] = np.nan  # never present with the column before
    x[n // 2 :, 7] = 0.3  # constant where column 5 is present
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(k)])


@pytest.mark.parametrize("k, block", [(30, 64), (30, 7), (300, 64)])
def test_all_pairs_equal_pandas(spark, monkeypatch, k, block):
    monkeypatch.setattr(gram, "BLOCK", block)
    data = frame(k, 400, k)
    want = data.corr().to_numpy()
    got = pf.corr_matrix(spark.createDataFrame(data).repartition(5), list(data.columns))
    rows = got.collect()
    assert len(rows) == k * (k - 1) // 2
    for r in rows:
        i, j = int(r["col_a"][1:]), int(r["col_b"][1:])
        assert i < j
        odd = {3, 4} & {i, j} or {i, j} in ({5, 6}, {5, 7})
        assert r["corr"] is None if odd else r["corr"] == pytest.approx(want[i, j], abs=1e-7), (i, j)
    assert len(plan_of(got)) < 5000


def test_no_rows(spark):
    empty = spark.createDataFrame([], ", ".join(f"c{i} double" for i in range(30)))
    assert pf.corr_matrix(empty, empty.columns).where("corr is not null").count() == 0
