"""Sliding medians and products, and the columns made of them, against windows taken one by one."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest

from quantloom.operators.rolling import Rows
from quantloom.operators.sliding import price_volume, sliding_median, sliding_product


@pytest.mark.parametrize("kind", ["any", "ties", "outlier", "holes"])
def test_against_windows_taken_one_by_one(kind):
    rng = np.random.default_rng(9)
    x = rng.random(700) + 0.5
    if kind == "ties":
        x = rng.integers(0, 4, 700).astype(float)
    elif kind == "outlier":
        x[rng.random(700) < 0.01] = 1e12
    elif kind == "holes":
        x[rng.random(700) < 0.02] = np.nan
    for n in (1, 2, 5, 6, 121, 700, 701):
        medians, products = sliding_median(x, n), sliding_product(x, n)
        for i in range(len(x)):
            w = x[i - n + 1 : i + 1] if i >= n - 1 else np.array([np.nan])
            assert np.array_equal(medians[i], np.median(w), equal_nan=True)
            assert products[i] == pytest.approx(w.prod(), rel=1e-12, nan_ok=True)


def test_nulls_and_zeros_give_null(spark):
    close, amount = [10.0, 11.0, 0.0, 12.0, 12.0, 15.0, None, 16.0, 18.0], [4.0, 0.0, 0.0, 0.0, 8.0, 6.0, 6.0, 9.0, None]
    df = spark.createDataFrame([("x", date(2020, 1, 1) + timedelta(days=i), c, a, "kept") for i, (c, a) in enumerate(zip(close, amount, strict=True))], "code string, date date, close double, amount double, other string")
    found = price_volume(df.repartition(3), Rows(), (2,)).orderBy("date").collect()
    # The median over three rows is 0 up to row 4, so ratios are known from row 5 on; closes of rows 6 are missing.
    assert [r.Market_Insight_2D for r in found] == [None, None, None, None, None, pytest.approx((15 / 12 - 1) / (6 / 6) * 100), None, None, None]
    assert not any(r.PV_2D for r in found[:6]) and {r.other for r in found} == {"kept"} and price_volume(df.limit(0), Rows(), (2,)).count() == 0
