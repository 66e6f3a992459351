"""Betas of long keys and short blocks against sums taken window by window."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest

from quantloom.operators.rolling import Rows, betas


def _want(a, m, n, t, half_life):
    w = 0.5 ** (np.arange(n)[::-1] / half_life)
    x, y = a[t - n + 1 : t + 1], m[t - n + 1 : t + 1]
    if t < n or np.isnan(x * y).any():
        return None
    return (w * (x - x.mean()) * (y - y.mean())).sum() / (w * (y - y.mean()) ** 2).sum()


@pytest.mark.parametrize(("size", "block", "half_life"), [(100_000, 4096, 63), (900, 252, 4), (4097, 4096, 63), (3, 4096, 63)])
def test_betas_of_long_keys(spark, size, block, half_life):
    rng = np.random.default_rng(8)
    m = rng.normal(size=size) / 50
    a = 1.3 * m + rng.normal(size=size) / 40
    a[rng.random(size) < 0.001] = np.nan
    day = date(1, 1, 1)
    rows = [("x", day + timedelta(days=i), None if np.isnan(a[i]) else float(a[i]), float(m[i])) for i in range(size)]
    found = betas(spark.createDataFrame(rows, "code string, date date, ra double, rm double"), Rows(), "ra", "rm", (5, 60, 252), half_life, block).toPandas().sort_values("date")
    at = {*range(min(size, 300)), *range(max(0, size - 300), size), *range(block - 5, min(size, block + 300)), *range(0, size, 997)}
    for n in (5, 60, 252):
        got = found[f"beta_{n}D"].to_numpy()
        for t in sorted(x for x in at if 0 <= x < size):
            want = _want(a, m, n, t, half_life)
            assert np.isnan(got[t]) if want is None else got[t] == pytest.approx(want, rel=1e-8, abs=1e-8), (n, t)
