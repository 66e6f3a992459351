"""Loads that go on from a stored state, and the sink of dates: repeated, cut off and odd ones."""

from __future__ import annotations

import os
from datetime import date, timedelta
from pathlib import Path

import numpy as np
import pytest

from conftest import TINY
from quantloom.operators.carried import Carried, carried_features, load_on, loaded
from quantloom.operators.recursive import recursive_features
from quantloom.operators.rolling import Rows, resume_days
from quantloom.sources import panels, sink

WHAT = Carried(ema_lags=(2, 5), macd_lags=(7, 14), rsi_lags=(7, 14), adx_lags=(7, 14))


def _bars(spark, lengths):
    rng, rows = np.random.default_rng(4), []
    for k, n in enumerate(lengths):
        x = 100 + np.cumsum(rng.normal(size=n))
        day = np.cumsum(rng.choice([1, 1, 1, 1, 3], n))
        rows += [(f"c{k}", date(2020, 1, 1) + timedelta(days=int(d)), int(d), float(v + 1), float(v - 1), float(v)) for d, v in zip(day, x, strict=True)]
    return spark.createDataFrame(rows, "code string, date date, day_idx long, high double, low double, close double")


def _whole(bars):
    found = resume_days(bars, Rows()).select("code", "date", "RESUME_DAYNUM")
    return recursive_features(bars, ema_lags=WHAT.ema_lags, macd_lags=WHAT.macd_lags, rsi_lags=WHAT.rsi_lags, adx_lags=WHAT.adx_lags).join(found, ["code", "date"])


def _same(got, want):
    got, want = ({(r.code, r.date): r.asDict() for r in df.collect()} for df in (got, want))
    assert set(got) == set(want)
    for k, row in want.items():
        for c, v in row.items():
            assert got[k][c] == v or abs(got[k][c] - v) < 1e-9, (k, c, got[k][c], v)


@pytest.mark.parametrize("ends", [(30, 60), (5, 12), (90, 91), (0, 400)])
def test_three_loads_equal_one(spark, tmp_path, ends):
    """Cuts within the first rows of a key and after them; keys that start late, or have no bars in a load."""
    bars = _bars(spark, [150, 40, 27, 8, 1]).cache()
    path = str(tmp_path / "loads")
    a, b = ends
    for i, part in enumerate((f"day_idx <= {a}", f"day_idx > {a} AND day_idx <= {b}", f"day_idx > {b}")):
        load_on(spark, bars.where(part), path, i, WHAT)
        load_on(spark, bars.where(part), path, i, WHAT)
    _same(loaded(spark, path, WHAT).drop("row_number"), _whole(bars))


def test_state_of_no_bars(spark):
    bars = _bars(spark, [3])
    assert carried_features(bars.limit(0), None, WHAT).count() == 0
    state = carried_features(bars, None, WHAT).where("s_rows IS NOT NULL")
    again = carried_features(bars.limit(0), state, WHAT)
    assert [r.asDict() for r in again.collect()] == [r.asDict() for r in state.collect()]


def test_a_load_reads_its_own_days(spark, tmp_path):
    q = panels.quotes_by_year(spark, TINY)
    late = q.where("year >= 1997")
    files = {f for f in q.inputFiles() if int(f.split("year=")[1][:4]) >= 1997}
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "1997" in plan.split("PartitionFilters")[1][:120]
    load_on(spark, q.where("year < 1997"), str(tmp_path), 0, WHAT)
    state = spark.read.parquet(f"{tmp_path}/load=0").where("s_rows IS NOT NULL")
    found = carried_features(late, state, WHAT)
    read = {f for f in found.select("date").distinct().join(late, "date").inputFiles() if "year=" in f}
    assert files <= read and state.count() == q.where("year < 1997").select("code").distinct().count()


def _table(spark, days, shift=0.0):
    return spark.createDataFrame([(date(2020, 1, 1) + timedelta(days=d), f"c{d % 3}", d + shift) for d in days], "date date, code string, v double")


def _rows(df):
    return sorted((r.date, r.code, r.v) for r in df.collect())


@pytest.fixture
def months(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.replace_dates(_table(spark, range(150)), path, date(2020, 1, 1), date(2020, 12, 31))
    return path


RANGE = (date(2020, 2, 10), date(2020, 4, 5))
NEW = [45, 50, 91]


def _wanted(spark):
    lo, hi = ((d - date(2020, 1, 1)).days for d in RANGE)
    return _rows(_table(spark, [d for d in range(150) if not lo <= d <= hi]).union(_table(spark, NEW, 0.5)))


def _untouched(path):
    return {str(f): f.stat().st_mtime_ns for m in ("01", "05") for f in Path(path, f"month=2020-{m}").iterdir()}


def test_writing_twice_is_writing_once(spark, months):
    before = _untouched(months)
    for _ in range(2):
        sink.replace_dates(_table(spark, NEW, 0.5), months, *RANGE)
        assert _rows(sink.stored_dates(spark, months)) == _wanted(spark)
    assert _untouched(months) == before


def test_months_without_new_rows_go(spark, months):
    sink.replace_dates(_table(spark, []), months, date(2020, 2, 1), date(2020, 3, 31))
    assert not Path(months, "month=2020-02").exists() and not Path(months, "month=2020-03").exists()
    assert _rows(sink.stored_dates(spark, months)) == _rows(_table(spark, [d for d in range(150) if not 31 <= d <= 90]))


def test_rows_of_other_days_are_refused(spark, months):
    before = _rows(sink.stored_dates(spark, months))
    for stray in (_table(spark, [5]), spark.createDataFrame([(None, "a", 1.0)], "date date, code string, v double")):
        with pytest.raises(ValueError, match="outside"):
            sink.replace_dates(stray, months, *RANGE)
    assert _rows(sink.stored_dates(spark, months)) == before


def test_a_write_cut_off_before_its_plan_changes_nothing(spark, months, monkeypatch):
    before = _rows(sink.stored_dates(spark, months))

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(type(spark), "createDataFrame", fails)
        sink.replace_dates(_table_of(spark), months, *RANGE)
    assert _rows(spark.read.parquet(months)) == before and Path(months, sink.STAGED).exists()
    assert _rows(sink.stored_dates(spark, months)) == before and not Path(months, sink.STAGED).exists()


def _table_of(spark):
    return spark.sql("SELECT DATE '2020-02-15' AS date, 'c0' AS code, 45.5D AS v")


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_write_cut_off_half_way_is_carried_through(spark, months, monkeypatch, moved):
    calls, repair = [], sink.repair
    with monkeypatch.context() as m:
        m.setattr(sink, "repair", lambda *a: calls.append(1) or (repair(*a) if len(calls) == 1 else None))
        sink.replace_dates(_table(spark, NEW, 0.5), months, *RANGE)
    staged = sorted(Path(months, sink.STAGED).glob("month=*"))
    assert len(staged) == 2
    for s in staged[:moved]:
        target = Path(months, s.name)
        for f in target.iterdir():
            f.unlink()
        target.rmdir()
        os.rename(s, target)
    if moved == 2:
        # The folder of the month that has gone is deleted before its successor is there.
        assert Path(months, "month=2020-03").exists()
    assert _rows(sink.stored_dates(spark, months)) == _wanted(spark)
    assert not Path(months, sink.PLAN).exists()


def test_a_year_of_bars_lies_in_several_buckets(spark):
    """A year was one task's before, both when it was written and when it was read."""
    q = panels.quotes_by_year(spark, TINY)
    assert len([f for f in q.inputFiles() if "year=1997" in f]) > 1
