"""Correlations of very many columns from masked products of column blocks (ST-6)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from venuelens.operators.materialize import materialize
from venuelens.operators.quantiles import number

#: Columns of a block; a cell of two blocks has SUMS * BLOCK ** 2 numbers.
BLOCK, SUMS = 64, 6

#: A variance below this share of the mean square about the column's shift is rounding, not spread.
_NOTHING = 1e-13


def _cells(batches: Iterator[pa.RecordBatch], shifts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each pair of column blocks of a task: n, and the sums of x, y, xx, yy, xy over rows where both are present."""
    k = len(shifts)
    edges = list(range(0, k, BLOCK))
    sums = {(a, b): 0.0 for a in edges for b in edges if a <= b}
    rows = 0
    for batch in batches:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.float64) - shifts
        there = ~np.isnan(x)
        x, mask, rows = np.where(there, x, 0.0), there.astype(np.float64), rows + batch.num_rows
        for a, b in sums:
            xa, ma, xb, mb = x[:, a : a + BLOCK], mask[:, a : a + BLOCK], x[:, b : b + BLOCK], mask[:, b : b + BLOCK]
            sums[a, b] = sums[a, b] + np.stack([ma.T @ mb, xa.T @ mb, ma.T @ xb, (xa * xa).T @ mb, ma.T @ (xb * xb), xa.T @ xb])
    if rows:
        for (a, b), s in sums.items():
            yield pa.RecordBatch.from_pydict({"a": [a], "b": [b], "sums": [s.tobytes()]})


def _added(group: pa.Table) -> pa.Table:
    total = reduce(np.add, (np.frombuffer(s) for s in group.column("sums").to_pylist()))
    return pa.table({"a": group.column("a")[:1], "b": group.column("b")[:1], "sums": [total.tobytes()]})


def gram_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_a, col_b, corr) of every pair of columns, in their order, over the rows where both are present; NULL where one is constant there.

    Rows are read twice: for a shift of each column, which keeps the sums accurate, and for products of blocks of columns in every task. A task sends one cell for
    each pair of blocks, whatever its rows, and the cells of a pair of blocks are added up, so plans do not grow with the pairs.
    """
    x = df.select(*[number(c).alias(c) for c in cols])
    # A mean may round away from the value of a constant column, so shifts lie at a value: the least, or 0 where that is infinite.
    low = x.agg(*[F.min(c).alias(c) for c in cols]).first()
    shifts = np.array([low[c] if low[c] is not None and np.isfinite(low[c]) else 0.0 for c in cols])
    cells = x.mapInArrow(lambda batches: _cells(batches, shifts), "a long, b long, sums binary")
    return materialize(cells.groupBy("a", "b").applyInArrow(_added, "a long, b long, sums binary")).mapInArrow(
        lambda batches: _correlated(batches, list(cols)), "col_a string, col_b string, corr double"
    )


def _correlated(batches: Iterator[pa.RecordBatch], cols: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, sums in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sums"))):
            wide, high = min(BLOCK, len(cols) - a), min(BLOCK, len(cols) - b)
            n, sx, sy, xx, yy, xy = np.frombuffer(sums).reshape(SUMS, wide, high)
            with np.errstate(divide="ignore", invalid="ignore"):
                vx, vy = xx / n - (sx / n) ** 2, yy / n - (sy / n) ** 2
                corr = (xy / n - sx / n * (sy / n)) / np.sqrt(vx * vy)
                spread = (n > 0) & (vx > _NOTHING * xx / n) & (vy > _NOTHING * yy / n)
            i, j = np.nonzero(np.arange(wide)[:, None] + a < np.arange(high)[None, :] + b)
            names = np.array(cols, dtype=object)
            yield pa.RecordBatch.from_pydict(
                {"col_a": pa.array(names[i + a], pa.string()), "col_b": pa.array(names[j + b], pa.string()), "corr": pa.array(corr[i, j].clip(-1, 1), mask=~spread[i, j])}
            )
