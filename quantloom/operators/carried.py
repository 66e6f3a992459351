"""Recursive features that go on from a stored state (A9 with D2, D10, D12, D14 and D28).

Each load leaves a row of state per key: the last of its averages, how many rows and how long a run it has seen, and,
while it is too short for the longest of the lags, its few bars. The next load reads its own new bars and these rows,
never older bars, and leaves the state of the following one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quantloom.operators.recursive import adx, ema, macd, rsi, smoothed

FAST, SLOW = 12, 26


@dataclass(frozen=True)
class Carried:
    """The features that a table of loads holds; most_run is the length up to which days since a suspension are counted."""

    ema_lags: tuple[int, ...] = ()
    macd_lags: tuple[int, ...] = ()
    rsi_lags: tuple[int, ...] = ()
    adx_lags: tuple[int, ...] = ()
    most_run: int = 30

    @property
    def names(self) -> list[str]:
        found = [f"EMA_{n}D" for n in self.ema_lags] + ["MACD_DIF_12_26D"] * bool(self.macd_lags)
        found += [f"MACD_{x}12_26_{n}D" for n in self.macd_lags for x in ("DEA_", "")]
        return found + [f"RSI_{n}D" for n in self.rsi_lags] + [f"ADX_{n}D" for n in self.adx_lags]

    @property
    def warm(self) -> int:
        """Rows after which every recursion runs."""
        return max([1, *self.ema_lags, *(SLOW - 1 + n for n in self.macd_lags), *(n + 1 for n in self.rsi_lags), *(2 * n for n in self.adx_lags)])


def _on(x: np.ndarray, last: float, alpha: float) -> np.ndarray:
    """Each row moves by alpha towards x from where the one before it was."""
    return smoothed(np.concatenate(([last], x)), 0, last, alpha)[1:]


def _moves(high: np.ndarray, low: np.ndarray, close: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """True range, rise and fall of each bar after the first."""
    up, down = np.diff(high), -np.diff(low)
    spread = np.maximum(high[1:], close[:-1]) - np.minimum(low[1:], close[:-1])
    return spread, np.where((up > down) & (up > 0), up, 0.0), np.where((down > up) & (down > 0), down, 0.0)


def _index(tr: np.ndarray, p: np.ndarray, m: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore"):
        p, m = np.where(tr == 0, 0, p / tr), np.where(tr == 0, 0, m / tr)
        return np.where(p + m == 0, 0, 100 * np.abs(p - m) / (p + m))


def _strength(u: np.ndarray, d: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(u + d == 0, 0.0, 100 * u / (u + d))


def averages(high: np.ndarray, low: np.ndarray, close: np.ndarray, what: Carried) -> list[float]:
    """The averages at the last of a key's first bars, at least what.warm of them, in the order in which they are carried."""
    out = [ema(close, n)[-1] for n in what.ema_lags]
    if what.macd_lags:
        out += [ema(close, FAST, SLOW - 1)[-1], ema(close, SLOW)[-1], *(macd(close, n)[1][-1] for n in what.macd_lags)]
    change = np.diff(close)
    for n in what.rsi_lags:
        out += [smoothed(x, n - 1, x[:n].mean(), 1 / n)[-1] for x in (np.maximum(change, 0), np.maximum(-change, 0))]
    moves = _moves(high, low, close)
    for n in what.adx_lags:
        # The mean move of n rows starts with n - 1 of them.
        out += [smoothed(x, n - 1, (x[: n - 1].sum() * (1 - 1 / n) + x[n - 1]) / n, 1 / n)[-1] for x in moves]
        out.append(adx(high, low, close, n)[-1])
    return out


def carry_on(high: np.ndarray, low: np.ndarray, close: np.ndarray, last: list[float], what: Carried) -> tuple[list[np.ndarray], list[float]]:
    """The features of the bars after the first, which is the last bar of the load before, and the averages then."""
    x, told, found, after = close[1:], iter(last), [], []

    def on(values: np.ndarray, alpha: float) -> np.ndarray:
        path = _on(values, next(told), alpha)
        after.append(path[-1])
        return path

    found += [on(x, 2 / (n + 1)) for n in what.ema_lags]
    if what.macd_lags:
        dif = on(x, 2 / (FAST + 1)) - on(x, 2 / (SLOW + 1))
        found.append(dif)
        for n in what.macd_lags:
            dea = on(dif, 2 / (n + 1))
            found += [dea, 2 * (dif - dea)]
    change = np.diff(close)
    found += [_strength(on(np.maximum(change, 0), 1 / n), on(np.maximum(-change, 0), 1 / n)) for n in what.rsi_lags]
    moves = _moves(high, low, close)
    for n in what.adx_lags:
        found.append(on(_index(*[on(v, 1 / n) for v in moves]), 1 / n))
    return found, after


def _from_start(high: np.ndarray, low: np.ndarray, close: np.ndarray, what: Carried) -> list[np.ndarray]:
    found = [ema(close, n) for n in what.ema_lags]
    for i, n in enumerate(what.macd_lags):
        dif, dea, hist = macd(close, n)
        found += [dif] * (not i) + [dea, hist]
    return found + [rsi(close, n) for n in what.rsi_lags] + [adx(high, low, close, n) for n in what.adx_lags]


_STATE = T.StructType([*(T.StructField(c, T.LongType()) for c in ("s_rows", "s_run", "s_day")), *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("s_highs", "s_lows", "s_closes", "s_averages"))])
_BARS = ("high", "low", "close")


def _loaded(key: str, what: Carried, schema: pa.Schema):
    def rows(n: int, columns: dict) -> pa.Table:
        return pa.table([pa.array(columns[f.name], f.type, from_pandas=True) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def compute(bars: pa.Table, state: pa.Table) -> pa.Table:
        old = state.slice(0, 1).to_pylist()[0] if state.num_rows else None
        if not bars.num_rows:
            return rows(1, {c: [v] for c, v in old.items()})
        bars = bars.sort_by("date")
        seen, run, day = (old["s_rows"], old["s_run"], old["s_day"]) if old else (0, 0, None)
        before = [np.array(old[c] if old else [], float) for c in ("s_highs", "s_lows", "s_closes")]
        path = [np.concatenate((b, bars.column(c).to_numpy())) for b, c in zip(before, _BARS, strict=True)]
        total, last = seen + bars.num_rows, []
        if seen < what.warm:
            values = [v[seen:] for v in _from_start(*path, what)]
            last = averages(*path, what) if total >= what.warm else []
        else:
            values, last = carry_on(*path, old["s_averages"], what)
        # A run is counted from the first suspension on: 0 before it, then the rows since the last one.
        runs = []
        for d in bars.column("day_idx").to_pylist():
            run = 1 if day is not None and d - day > 1 else run + 1 if run else 0
            day = d
            runs.append(run if run <= what.most_run else 0)
        kept = path if total < what.warm else [v[-1:] for v in path]
        of_key = bars.column(key)
        found = rows(bars.num_rows, {key: of_key.to_pylist(), "date": bars.column("date").to_pylist(), "row_number": np.arange(seen + 1, total + 1), "RESUME_DAYNUM": runs, **dict(zip(what.names, values, strict=True))})
        told = {"s_rows": total, "s_run": run, "s_day": day, "s_highs": kept[0].tolist(), "s_lows": kept[1].tolist(), "s_closes": kept[2].tolist(), "s_averages": last}
        return pa.concat_tables([found, rows(1, {key: [of_key[0].as_py()], **{c: [v] for c, v in told.items()}})])

    return compute


def carried_features(bars: DataFrame, state: DataFrame | None, what: Carried, *, key: str = "code") -> DataFrame:
    """The features of new bars (key, date, day_idx, high, low, close without nulls) after the state that the loads before left.

    Rows with a date are features: row_number, the columns of what.names and RESUME_DAYNUM. The others are the state of
    each key, of those without new bars as well. bars must be later than those of the state.
    """
    schema = T.StructType([bars.schema[key], T.StructField("date", T.DateType()), T.StructField("row_number", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in what.names), T.StructField("RESUME_DAYNUM", T.LongType()), *_STATE])
    if state is None:
        state = bars.sparkSession.createDataFrame([], T.StructType([bars.schema[key], *_STATE]))
    needed = bars.select(key, "date", "day_idx", *_BARS)
    return needed.groupBy(key).cogroup(state.select(key, *_STATE.names).groupBy(key)).applyInArrow(_loaded(key, what, to_arrow_schema(schema)), schema)


def load_on(spark: SparkSession, bars: DataFrame, path: str, number: int, what: Carried, *, key: str = "code") -> None:
    """Load number (from 0 on): new bars and the state of the load before to path/load=number. Loading again replaces the same load."""
    state = spark.read.parquet(f"{path}/load={number - 1}").where("s_rows IS NOT NULL") if number else None
    carried_features(bars, state, what, key=key).write.mode("overwrite").parquet(f"{path}/load={number}")


def loaded(spark: SparkSession, path: str, what: Carried, *, key: str = "code") -> DataFrame:
    """The features of all loads."""
    return spark.read.parquet(path).where("date IS NOT NULL").select(key, "date", "row_number", *what.names, "RESUME_DAYNUM")
