"""Bundles: names by rule, two exchanges whatever they hold, gaps before and within a key, ties, empty tables."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from quantloom.operators.bundles import BANDS, BAR, BUNDLES, L7, Bundle, ValueSet, bundle_features
from quantloom.operators.recursive import ema, from_first, macd, rsi
from quantloom.operators.rolling import Rows

R = Rows()
LONG = [n for n in L7 if n >= 2]


def value_names(p: str) -> set[str]:
    kinds = ("", "_DIFF", "_DIFF_SIGN", "_DIFF_PLUS_COUNT", "_DIFF_NEGATIVE_COUNT", "_DIFF_CON_PLUS_COUNT", "_DIFF_CON_NEGATIVE_COUNT")
    names = {f"{p}{m}{k}_{n}D" for m in ("MA", "EMA", "WMA") for k in kinds for n in LONG}
    names |= {f"{p}RET_{n}D" for n in L7} | {f"{p}STD_{n}D" for n in LONG if n >= 5} | {f"{p}BBANDS_{s}_{n}D" for s in ("UPPER", "LOWER") for n in BANDS}
    return names | {f"{p}MACD_DIF_12_26D"} | {f"{p}MACD_{x}12_26_{n}D" for x in ("DEA_", "") for n in BANDS}


BARS = {f"{k}_{n}D" for k in ("AD_DIFF", "ADX", "CCI", "RSI", "STOCH_K", "STOCH_D", "WILLER", "VR") for n in BANDS}
PRICE_SET = value_names("") | value_names("V") | BARS | {f"OBV_DIFF_{n}D" for n in L7} | {"VOLUME_RATIO"}
STATIONARY = {f"PRICE_TO_MA_{n}D" for n in LONG} | value_names("AMT") | {f"AMT_OBV_DIFF_{n}D" for n in L7} | {f"AMOUNT_RATIO_{n}D" for n in LONG}
NAMES = {
    "price": PRICE_SET | {f"{k}_{n}D" for k in ("TURNOVER_ROLLING_SUM", "AMPLITUDE") for n in L7}, "stationary": STATIONARY, "series": PRICE_SET,
    "close_only": value_names(""), "ratio_only": {f"PRICE_TO_MA_{n}D" for n in LONG}, "series_stationary": STATIONARY,
}


def bars(spark, rows):
    return spark.createDataFrame(rows, "date DATE, code STRING, " + ", ".join(f"{c} DOUBLE" for c in BAR))


def some(n: int, code: str = "a", seed: int = 3):
    x = np.random.default_rng(seed).integers(50, 150, (n, len(BAR))).astype(float)
    x[:, 1], x[:, 2] = x[:, :4].max(axis=1), x[:, :4].min(axis=1)
    return [(dt.date(2000, 1, 1) + dt.timedelta(days=i), code, *map(float, x[i])) for i in range(n)]


@pytest.mark.parametrize("name", BUNDLES)
def test_names_and_exchanges(spark, name):
    found = bundle_features(bars(spark, some(70)), R, BUNDLES[name])
    assert set(found.columns) == {"date", "code"} | NAMES[name] and len(found.columns) == len(set(found.columns))
    plan = found._jdf.queryExecution().executedPlan().toString()
    kernels = plan.count("FlatMapGroupsInPandas")
    assert kernels == (0 if name == "ratio_only" else 1)
    assert plan.count("Exchange hashpartitioning") == 1 + kernels


def test_empty_table(spark):
    assert bundle_features(bars(spark, []), R, BUNDLES["series"]).count() == 0


def test_gaps_before_and_within(spark):
    """Rows before the first known value change nothing after it; a gap within takes the value before."""
    rows = some(70)
    blank = [(r[0] - dt.timedelta(days=5), "a", *[None] * len(BAR)) for r in rows[:5]]
    gap = [*rows[:40], (rows[40][0], "a", *[None] * len(BAR)), *rows[41:]]
    held = [*rows[:40], (rows[40][0], "a", *rows[39][2:]), *rows[41:]]
    bundle = Bundle((ValueSet(), ValueSet("amount", "AMT")), to_average=(("close", "PRICE"),), filled=True)
    by_date = lambda rs: {r["date"]: r.asDict() for r in bundle_features(bars(spark, rs), R, bundle).collect()}
    want, got = by_date(held), by_date(blank + gap)
    assert set(got) - set(want) == {r[0] for r in blank}
    # Runs of a sign can't be longer for unknown rows before them but at the first row itself.
    for d, r in want.items():
        for c, v in r.items():
            if "_CON_" not in c:
                assert got[d][c] == (pytest.approx(v, rel=1e-9, abs=1e-6) if isinstance(v, float) else v), (d, c)
    assert all(got[r[0]][c] is None for r in blank for c in got[r[0]] if "CON" not in c and c not in ("date", "code"))


def test_equal_values(spark):
    rows = [(dt.date(2000, 1, 1) + dt.timedelta(days=i), "a", *[100.0] * len(BAR)) for i in range(40)]
    last = bundle_features(bars(spark, rows), R, BUNDLES["price"]).orderBy("date").collect()[-1]
    assert last["MA_DIFF_20D"] == last["EMA_DIFF_20D"] == last["WMA_DIFF_20D"] == 0 and last["MA_DIFF_SIGN_20D"] == 0
    assert last["MA_DIFF_NEGATIVE_COUNT_20D"] == 20 and last["RSI_14D"] == last["ADX_14D"] == last["CCI_14D"] == 0
    assert last["VR_14D"] is None and last["VOLUME_RATIO"] == 1


def test_keys_do_not_mix(spark):
    one, other = some(70, "a"), some(70, "b", seed=4)
    both = bundle_features(bars(spark, one + other), R, BUNDLES["price"]).where("code = 'a'").orderBy("date").collect()
    assert both == bundle_features(bars(spark, one), R, BUNDLES["price"]).orderBy("date").collect()


@pytest.mark.parametrize("kernel", [lambda x: ema(x, 5), lambda x: rsi(x, 7), lambda x: macd(x, 9)[1]])
def test_from_first(kernel):
    x = np.random.default_rng(0).normal(100, 5, 80)
    late = np.concatenate((np.full(6, np.nan), x))
    np.testing.assert_allclose(from_first(kernel, late)[6:], kernel(x))
    assert np.isnan(from_first(kernel, np.full(9, np.nan))).all()
