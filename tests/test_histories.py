"""Histories lying one after the other: windows against brute force, batches of whole keys, features that no exchange carries."""

from __future__ import annotations

import numpy as np
import pytest

from quantloom.operators import bundles
from quantloom.operators.bundles import BUNDLES, bundle_features
from quantloom.operators.histories import Histories, rounded
from quantloom.operators.rolling import Rows
from quantloom.plans.window_queries import shown_bundle
from test_bundles import bars, some

R = Rows()
LENGTHS = (1, 5, 40, 2)


def rows():
    rng = np.random.default_rng(5)
    x = rng.integers(-9, 9, sum(LENGTHS)).astype(float)
    x[rng.random(len(x)) < 0.1] = np.nan
    return x, np.concatenate([np.arange(n) for n in LENGTHS])


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20, 45])
def test_windows_against_brute_force(n):
    x, place = rows()
    h = Histories({}, place)
    ends = [x[i - min(place[i], n - 1) : i + 1] for i in range(len(x))]
    known = [e[~np.isnan(e)] for e in ends]
    np.testing.assert_array_equal(h.total(x, n), [e.sum() if len(e) == n else np.nan for e in ends])
    np.testing.assert_array_equal(h.highest(x, n), [k.max() if len(k) else np.nan for k in known])
    np.testing.assert_array_equal(h.lowest(x, n), [k.min() if len(k) else np.nan for k in known])
    np.testing.assert_array_equal(h.known_total(x, n), [k.sum() if len(k) and place[i] >= n else np.nan for i, k in enumerate(known)])
    np.testing.assert_allclose(h.weighted(x, n), [(e * np.arange(1, n + 1)).sum() / (n * (n + 1) / 2) if len(e) == n else np.nan for e in ends], atol=1e-9)
    np.testing.assert_allclose(h.deviation(x, n), [e.std() if len(e) == n else np.nan for e in ends], atol=1e-9)
    np.testing.assert_array_equal(h.lag(x, n), [x[i - n] if place[i] >= n else np.nan for i in range(len(x))])


def test_runs_start_anew_with_each_key():
    place = np.array([0, 1, 2, 3, 4, 0, 1, 2])
    assert Histories({}, place).run(np.array([1, 1, 0, 1, 1, 1, 1, 1], bool)).tolist() == [0, 1, 0, 1, 2, 0, 1, 2]


def test_batches_hold_whole_keys_and_change_nothing(spark, monkeypatch):
    df = bars(spark, [r for i in range(9) for r in some(20 + i, f"k{i}", seed=i)])
    told = lambda: {(r["code"], r["date"]): r for r in bundle_features(df, R, BUNDLES["price"]).collect()}
    want = told()
    small = bundles.batches(df, R, 50)
    assert small.select("code", "__batch").distinct().count() == 9 and small.select("__batch").distinct().count() > 3
    assert max(r["count"] for r in small.groupBy("__batch").count().collect()) < 50 + 28
    monkeypatch.setattr(bundles, "batches", lambda df, rows, of=bundles.batches: of(df, rows, 50))
    assert told() == want and len(want) == sum(20 + i for i in range(9))


@pytest.mark.parametrize("name", ["price", "stationary", "series", "close_only"])
def test_features_are_not_exchanged(spark, name):
    plan = bundle_features(bars(spark, some(70)), R, BUNDLES[name])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInPandas") < plan.index("Exchange")


def test_some_features_are_those_of_the_whole_bundle(spark):
    df, some_names = bars(spark, some(70)), ("MA_DIFF_CON_PLUS_COUNT_20D", "EMA_DIFF_SIGN_5D", "MACD_DIF_12_26D", "RSI_28D", "STOCH_K_7D", "MACD_DEA_12_26_14D")
    whole = bundle_features(df, R, BUNDLES["price"]).select("date", "code", *some_names).orderBy("date").collect()
    assert bundle_features(df, R, BUNDLES["price"], some_names).select("date", "code", *some_names).orderBy("date").collect() == whole


def test_counts_and_plain_steps():
    """Counts keep their unknown ones; plain steps give what pandas gives, whose own way is left to histories with gaps."""
    import pandas as pd

    from quantloom.operators.recursive import smoothed

    assert bundles.counts(np.array([1.0, np.nan, 3.0])).tolist() == [1, pd.NA, 3]
    x = np.random.default_rng(1).normal(100, 5, 60)
    gap = np.where(np.arange(60) == 30, np.nan, x)
    for v in (x, gap):
        want = pd.Series(np.concatenate(([7.0], v[5:]))).ewm(alpha=0.2, adjust=False).mean()
        np.testing.assert_allclose(smoothed(v, 4, 7.0, 0.2)[4:], want, rtol=1e-12)


def test_rounds_as_sql_does():
    x = np.array([2.5, -2.5, 0.5, -0.4, 0.49999999999999994, 1234567.125, np.nan, np.inf, -0.0])
    np.testing.assert_array_equal(rounded(x, 0), [3, -3, 1, 0, 0, 1234567, np.nan, np.inf, 0])
    np.testing.assert_array_equal(rounded(x, 2)[:6], [2.5, -2.5, 0.5, -0.4, 0.5, 1234567.13])
    assert not np.signbit(rounded(x, 0)[[3, 8]]).any()


def test_batches_are_dealt_to_all_partitions(spark):
    """Few bytes go into the kernel and hundreds of columns come out, so its partitions aren't put together by what goes in."""
    found = bundle_features(bars(spark, [r for k in "abcdefgh" for r in some(70, k)]), R, BUNDLES["price"], shown=lambda c: (2, 0.0) if c == "MA_5D" else None)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = bundle_features(bars(spark, some(70, "a")), R, BUNDLES["price"])
    want, got = ({r["date"]: (r["MA_5D"], r["RSI_7D"]) for r in df.where("code = 'a'").collect()} for df in (plain, found))
    assert got == {d: (None if a is None else round(a, 2), b) for d, (a, b) in want.items()}


def test_no_number_of_a_shown_bundle_is_rounded_by_rows(spark):
    """84 of the stationary bundle's columns are rounded."""
    found = shown_bundle(bars(spark, some(70)), BUNDLES["stationary"])
    assert "round(" not in found._jdf.queryExecution().optimizedPlan().toString()
    last = found.orderBy("date").collect()[-1]
    amounts = [r[-2] for r in some(70)][-5:]
    assert last["AMTMA_5D"] == round(sum(amounts) / 5 + 0.0137) and last["AMOUNT_RATIO_5D"] == pytest.approx(amounts[-1] / (sum(amounts) / 5), abs=1e-6)
