"""Baskets that wait, chains of links, and quantiles over days."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.operators import cross_section as cs
from quantloom.operators import portfolio as pf


def test_first_day_from_a_day_on(spark):
    df = spark.createDataFrame([("a", 3), ("a", 9), ("a", 4), ("b", 1), ("c", 1), ("a", 3)], "k string, at long")
    days = spark.createDataFrame([("a", 4), ("a", 5), ("a", 8), ("b", 0), ("b", 7)], "k string, d long")
    got = sorted(tuple(r) for r in pf.first_from(df, days, ["k"], "at", "d", "found").select("k", "at", F.coalesce("found", F.lit(-1))).collect())
    assert got == [("a", 3, 4), ("a", 3, 4), ("a", 4, 4), ("a", 9, -1), ("b", 1, 7), ("c", 1, -1)]


def test_chains_of_any_length(spark):
    links = {"x": {i: i + 1 + i % 3 for i in range(100)}, "y": {5: 7, 7: None, 6: 7}, "z": {4: None}}
    rows = [(k, a, b) for k, v in links.items() for a, b in v.items()]
    want = set()
    for k, v in links.items():
        at = min(v)
        while at is not None:
            want.add((k, at))
            at = v.get(at)
    got = pf.chained(spark.createDataFrame(rows, "k string, here long, there long"), ["k"], "here", "there").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert not pf.chained(spark.createDataFrame([], "k string, here long, there long"), ["k"], "here", "there").count()


@pytest.mark.parametrize("seed", [1, 2])
def test_baskets_wait_until_all_is_sold(spark, seed):
    """Against a walk day by day: codes that can't be sold for long or at all, days without a basket."""
    rng, codes, last = random.Random(seed), [f"c{i}" for i in range(8)], 80
    sellable = {c: {d for d in range(last) if rng.random() < 0.6 and not (c == "c7" and d > 60)} for c in codes}
    baskets = {(layer, d): rng.sample(codes, rng.randint(1, 3)) for layer in (0, 1) for d in range(3, last) if rng.random() < 0.8}
    rows = [(layer, d, c, 1 / len(b)) for (layer, d), b in baskets.items() for c in b]
    want = set()
    for layer in (0, 1):
        held, sold = {}, 0
        for d in range(last):
            for c in [c for c, due in held.items() if d >= due and d in sellable[c]]:
                del held[c]
            if not held and (layer, d) in baskets:
                held = {c: d + 5 for c in baskets[layer, d]}
                for c in held:
                    sold = min((x for x in sellable[c] if x >= d + 5), default=None)
                    want.add((layer, d, c, sold))
    found = pf.waiting_baskets(spark.createDataFrame(rows, "layer long, day_idx long, code string, weight double"), spark.createDataFrame([(c, d) for c, ds in sellable.items() for d in ds], "code string, day_idx long"), 5)
    got = {(r.layer, r.day_idx, r.code, r.sold_idx) for r in found.collect()}
    assert got == want and any(x[3] and x[3] > x[1] + 5 for x in want)
    calendar = spark.createDataFrame([(date(2020, 1, 1) + timedelta(days=d), d) for d in range(last)], "date date, day_idx long")
    held = pf.held_until(found, calendar).groupBy("layer", "code", "date").count()
    assert held.where("count > 1").count() == 0
    assert held.count() == sum((s if s is not None else last) - d for _, d, _, s in want)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_weights_by_events(spark):
    """Against a count day by day: accounts, positions that stay open, last no day, or begin after the calendar."""
    rng, last = random.Random(3), 40
    positions = [(a, s, None if rng.random() < 0.2 else s + rng.randint(-1, 9)) for a in ("x", "y") for s in (rng.randint(0, last + 3) for _ in range(60))]
    calendar = spark.createDataFrame([(date(2020, 1, 1) + timedelta(days=d), d) for d in range(last)], "date date, day_idx long")
    found = pf.over_weight(spark.createDataFrame([*positions, ("x", None, 3)], "account string, start_idx long, end_idx long"), calendar, ["account"], 5)
    want = {}
    for a in ("x", "y"):
        for d in range(last):
            n = sum(k == a and s <= d and (e is None or d < e) for k, s, e in positions)
            if n > 5:
                want[a, date(2020, 1, 1) + timedelta(days=d)] = n / 5
    assert {(r.account, r.date): r.weight for r in found.collect()} == want and "NestedLoop" not in _plan(found)


def test_days_held_by_a_running_count(spark):
    trade_days = [date(2020, 1, d) for d in (2, 3, 6, 7, 8, 13, 14)]
    calendar = spark.createDataFrame([(d, i) for i, d in enumerate(trade_days)], "date date, day_idx long")
    starts = [date(2020, 1, d) for d in (1, 2, 4, 6, 6, 12, 13, 14)]
    positions = spark.createDataFrame([("a", s, 1.0, 10) for s in starts], "code string, start_date date, open_price double, volume int")
    prices = spark.createDataFrame([("a", date(2020, 1, 13), 3.0)], "code string, date date, close double")
    found = pf.marked_to_market(positions, prices, calendar, "2020-01-13")
    want = [(s, n, 20.0) for s in starts if (n := sum(s <= d <= date(2020, 1, 13) for d in trade_days))]
    assert sorted((r.start_date, r.holding_period, r.floating_PnL) for r in found.collect()) == want and "NestedLoop" not in _plan(found)


def _thresholds(rows, days, share):
    of = defaultdict(list)
    for d, s in rows:
        of[d] += [s] if s is not None and s == s else []
    out, lo = {}, min(of, default=0)
    for t in of:
        x = sorted(s for d in of if t - days <= d < t for s in of[d])
        at = (len(x) - 1) * share
        out[t] = (x[int(np.floor(at))] + x[int(np.ceil(at))]) / 2 if x and t - lo >= days else 0.0
    return out


@pytest.mark.parametrize(("kind", "share"), [("any", 0.99), ("ties", 0.5), ("constant", 0.99), ("outlier", 0.9), ("signs", 0.3)])
def test_rolling_threshold_against_sorting(spark, kind, share):
    rng, rows = np.random.default_rng(7), []
    for d in range(0, 60):
        if d % 11 == 4:
            continue
        n = int(rng.integers(1, 30))
        draw = {"any": rng.random(n), "ties": rng.integers(0, 3, n) / 4, "constant": np.full(n, 0.25 if d < 30 else -0.5), "outlier": np.where(rng.random(n) < 0.05, 1e12, rng.random(n)), "signs": rng.normal(size=n) * 10.0 ** rng.integers(-300, 300, n)}[kind]
        rows += [(d, float(v)) for v in draw] + [(d, None), (d, float("nan")), (d, -0.0 if kind == "ties" else float(draw[0]))]
    got = {r.day_idx: r.threshold for r in cs.rolling_threshold(spark.createDataFrame(rows, "day_idx long, score double").repartition(3), 7, share).collect()}
    want = _thresholds(rows, 7, share)
    assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d], rel=1e-12, abs=0) for d in want)


def test_rolling_threshold_of_nothing(spark):
    assert cs.rolling_threshold(spark.createDataFrame([], "day_idx long, score double"), 7).count() == 0
