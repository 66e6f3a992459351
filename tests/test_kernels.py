"""Hand-worked series, messy rows and invariants."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TINY
from quantloom.functions import clean
from quantloom.operators import assemble, evaluate, timing
from quantloom.operators import portfolio as pf
from quantloom.operators.cross_section import category_rank, market_rank
from quantloom.operators.recursive import adx, ema, macd, rsi
from quantloom.operators.rolling import Rows, resume_days
from quantloom.sources import io, panels

R = Rows()


def day(i: int) -> dt.date:
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def test_ema_is_seeded_by_the_mean():
    x = np.array([1.0, 2, 3, 4, 5])
    assert np.allclose(ema(x, 3)[2:], [2, 3, 4]) and np.isnan(ema(x, 3)[:2]).all()
    assert np.isnan(ema(x, 9)).all()


def test_macd_starts_with_its_signal():
    x = np.arange(60.0) ** 1.5
    dif, dea, hist = macd(x, 7)
    assert np.isnan(dif[:31]).all() and not np.isnan(dif[31:]).any()
    assert np.allclose(hist[31:], 2 * (dif - dea)[31:])
    fast = x[14:26].mean()
    slow = x[:26].mean()
    first = fast - slow
    difs = [first]
    for v in x[26:32]:
        fast += (v - fast) * 2 / 13
        slow += (v - slow) * 2 / 27
        difs.append(fast - slow)
    assert np.isclose(dea[31], np.mean(difs[:6] + [difs[6]]) if len(difs) == 7 else 0)


def test_rsi_of_a_ramp_and_of_flat_prices():
    assert np.allclose(rsi(np.arange(20.0), 5)[5:], 100)
    assert np.allclose(rsi(np.ones(20), 5)[5:], 0)
    assert np.isnan(rsi(np.arange(5.0), 5)).all()


def test_adx_against_a_loop():
    rng = np.random.default_rng(3)
    c = 100 + rng.normal(size=60).cumsum()
    h, low, n = c + rng.random(60), c - rng.random(60), 5
    tr = p = m = 0.0
    dx, out = [], {}
    for i in range(1, 60):
        up, down = h[i] - h[i - 1], low[i - 1] - low[i]
        t = max(h[i], c[i - 1]) - min(low[i], c[i - 1])
        a, b = (up if up > down and up > 0 else 0), (down if down > up and down > 0 else 0)
        if i < n:
            tr, p, m = tr + t, p + a, m + b
            continue
        tr, p, m = tr - tr / n + t, p - p / n + a, m - m / n + b
        dx.append(100 * abs(p - m) / (p + m))
        if len(dx) == n:
            out[i] = np.mean(dx)
        elif len(dx) > n:
            out[i] = (out[i - 1] * (n - 1) + dx[-1]) / n
    got = adx(h, low, c, n)
    assert np.isnan(got[: 2 * n - 1]).all() and np.allclose(got[2 * n - 1 :], list(out.values()))


def test_turning_points_alternate_and_fill_backwards():
    close = np.concatenate((np.linspace(100, 150, 11), np.linspace(145, 100, 10), np.linspace(105, 160, 12)))
    label = timing.turning_points(close, 0.2, 0.05)
    assert label[10] == 1 and label[20] == -1 and label[-1] == 1
    assert set(label[11:21]) == {-1.0} and set(label[21:]) == {1.0}
    assert np.isnan(timing.turning_points(np.linspace(1, 2, 20), 0.2, 0.05)).all()


def test_merged_bins_merge_equal_rates_only():
    assert timing.merged_bins([1, 2, 3], [50, 50, 5], [50, 50, 95]) == [2, 3]
    assert timing.merged_bins([1, 2, 3], [0, 10, 10], [0, 10, 10]) == [3]


def test_chi_merge_and_bins(spark):
    rows = [(i, float(i % 50), int(i % 50 >= 25)) for i in range(500)] + [(500, None, 1)]
    df = spark.createDataFrame(rows, "id int, v double, y int")
    cuts = timing.chi_merge(df, ["v"], "y")
    found = [r.upper for r in cuts.orderBy("position").collect()]
    assert len(found) == 2 and 24 <= found[0] < 25 and found[1] == float("inf")
    flags = timing.assigned_bins(df, cuts, ["v"])
    assert flags.agg(F.sum("v_bin_0"), F.sum("v_bin_1")).first() == (250, 250)


def test_short_codes_have_no_full_window(spark):
    df = spark.createDataFrame([("a", day(0), 1.0), ("b", day(0), 1.0), ("b", day(1), None), ("b", day(2), 3.0)], "code string, date date, close double")
    got = df.select("code", "date", R.sma("close", 2).alias("m"), R.ret("close", 2).alias("r")).collect()
    assert all(r.m is None for r in got) and [r.r for r in got if r.r is not None] == [2.0]


def test_resumption_counts_stop_after_thirty_days(spark):
    rows = [("a", i, day(i)) for i in list(range(3)) + list(range(5, 40))]
    got = [r.RESUME_DAYNUM for r in resume_days(spark.createDataFrame(rows, "code string, day_idx int, date date"), R).orderBy("date").collect()]
    assert got == [0, 0, 0, *range(1, 31), *[0] * 5]


def test_rank_denominators_differ_with_ties_at_the_bottom(spark):
    df = spark.createDataFrame([(day(0), c, "x", v) for c, v in (("a", 3.0), ("b", 1.0), ("c", 1.0), ("d", None))], "date date, code string, cat string, v double")
    market = {r.code: r.v_RANK for r in market_rank(df, ["v"]).collect()}
    category = {r.code: r.v_RANK for r in category_rank(df, "cat", ["v"]).collect()}
    assert market == {"a": 1 / 3, "b": 2.5 / 3, "c": 2.5 / 3, "d": None}
    assert category == {"a": 1 / 2.5, "b": 1.0, "c": 1.0, "d": None}


def test_replacing_a_range_twice_is_once(spark):
    old = spark.createDataFrame([(day(i), i) for i in range(6)], "date date, v int")
    new = spark.createDataFrame([(day(2), 20), (day(4), 40)], "date date, v int")
    once = io.replace_range(old, new)
    assert sorted(once.collect()) == sorted(io.replace_range(once, new).collect()) and once.count() == 5
    assert sorted(io.replace_range(old, new.limit(0)).collect()) == sorted(old.collect())


def test_load_plans(spark):
    cal = spark.createDataFrame([(day(i), i) for i in range(400)], "date date, day_idx int")
    rows = lambda n: spark.createDataFrame([(day(i),) for i in range(n)], "date date")
    plan = lambda s, t, today=None: tuple(io.load_plan(rows(s), t, cal, (5,), today=today).first())
    assert plan(300, rows(1).limit(0))[0] == "full"
    assert plan(300, rows(290)) == ("incremental", day(289), day(37))
    assert plan(300, rows(300), day(299))[0] == "rerun" and plan(300, rows(300), day(350))[0] == "nothing"


def test_split_is_the_same_at_any_partitioning(spark):
    df = panels.quotes(spark, TINY).select("date", "code")
    a, b = assemble.hash_split(df, "date", "code")
    c, _ = assemble.hash_split(df.repartition(17), "date", "code")
    assert sorted(a.collect()) == sorted(c.collect()) and a.count() + b.count() == df.count()
    assert 0.85 < a.count() / df.count() < 0.95


def test_balanced_classes_are_equal(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1000, None)], "id int, y int")
    assert {(r.y, r["count"]) for r in assemble.balanced(df, "y", "id").groupBy("y").count().collect()} == {(0, 100), (1, 100)}


def test_chains_and_back(spark):
    df = spark.createDataFrame([("a", day(i), float(i)) for i in range(5)] + [("b", day(0), 9.0)], "code string, date date, v double")
    chains = assemble.chains(df, ["code"], ["v"], 3)
    back = assemble.unchained(chains.withColumnRenamed("chain", "predicted"), ["code"])
    assert chains.count() == 3 and sorted(r.v for r in back.collect()) == [0, 1, 2, 3, 4]


def test_auc_and_ks_of_tied_scores(spark):
    df = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.5), ("m", 1, 0.5), ("m", 0, 0.1)], "g string, y int, s double")
    assert evaluate.auc(df, ["g"], "y", "s").first().auc == 0.875
    assert evaluate.ks(df, ["g"], "y", "s").first().ks == 0.5


def test_positions_open_and_close_in_turn(spark):
    rows = [("a", day(i), i, day(i + 1), i + 1) for i in (1, 0, 3)]
    acts = [(c, d, a, f, i) for (c, d, _, f, i), a in zip(rows, (0, 1, 0), strict=True)] + [("a", day(5), 1, day(6), 6), ("a", day(7), 1, day(8), 8), ("b", day(2), 0, day(3), 3)]
    df = spark.createDataFrame(acts, "code string, date date, action int, fill_date date, fill_idx int")
    got = sorted((r.code, r.start_idx, r.end_idx) for r in pf.replayed(df, ["code"]).collect())
    assert got == [("a", 2, 6), ("b", 3, None)]


def test_layers_partition_the_candidates(spark):
    df = spark.createDataFrame([(day(0), 0, f"{i}", i / 7) for i in range(7)], "date date, day_idx int, code string, s double")
    got = pf.layers(df, "s", 3, 5).groupBy("layer").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).orderBy("layer").collect()
    assert [r.n for r in got] == [2, 2, 3] and all(abs(r.w - 1) < 1e-12 for r in got)


def test_a_new_basket_waits_until_the_old_one_is_sold(spark):
    days = spark.createDataFrame([(i,) for i in range(16)], "day_idx long")
    blocked = spark.createDataFrame([(i,) for i in (5, 6, 7, 8, 9, 10, 11, 15)], "day_idx long")
    got = sorted(map(tuple, pf.after_closing(days, blocked, 5).collect()))
    assert got == [(0, 0), (5, 12)]


def test_over_weight_days_are_named(spark):
    cal = spark.createDataFrame([(day(i), i) for i in range(4)], "date date, day_idx int")
    pos = spark.createDataFrame([("a", 0, None), ("b", 1, 2)], "code string, start_idx int, end_idx int")
    assert [r.date for r in pf.over_weight(pos, cal, [], 1).collect()] == [day(1)]


@pytest.mark.parametrize(("text", "want"), [("1.2亿", 1.2e8), ("3万", 3e4), ("7", 7.0), ("x", None), (None, None)])
def test_chinese_numbers(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(clean.chinese_number("t")).first()[0] == want


def test_other_text(spark):
    df = spark.createDataFrame([("3.2%", "1,234", "2020年3月7日", "20200307", "10派1.6转2", float("inf"))], "a string, b string, c string, d string, e string, f double")
    got = df.select(clean.percent_number("a"), clean.percent_number("b"), clean.date_text("c"), clean.date_text("d"), clean.cash_dividend("e"), clean.nan_inf_to_null("f")).first()
    assert abs(got[0] - 0.032) < 1e-12 and tuple(got[1:]) == (1234.0, dt.date(2020, 3, 7), dt.date(2020, 3, 7), 1.6, None)
