"""Features whose value depends on the one before (D2, D10, D12, D14): one grouped kernel per key's history.

A group is one code's bars, thousands of rows at most; all recursions of a code run in one exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def smoothed(x: np.ndarray, first: int, seed: float, alpha: float) -> np.ndarray:
    """seed at row first, then each row moves by alpha towards x; null before."""
    out = np.full(len(x), np.nan)
    rest = x[first + 1 :]
    if first < len(x) and not np.isnan(rest).any() and not np.isnan(seed):
        # Plain steps take less time than pandas needs to set up its average for one short history.
        out[first:] = list(accumulate(rest.tolist(), lambda y, v: y + alpha * (v - y), initial=float(seed)))
    elif first < len(x):
        out[first:] = pd.Series(np.concatenate(([seed], x[first + 1 :]))).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return out


def ema(x: np.ndarray, n: int, first: int | None = None) -> np.ndarray:
    """Seeded by the mean of the n rows that end at row first (the n-th by default)."""
    first = n - 1 if first is None else first
    return smoothed(x, first, x[first - n + 1 : first + 1].mean() if first < len(x) else np.nan, 2 / (n + 1))


def macd(x: np.ndarray, n: int, fast: int = 12, slow: int = 26) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Difference, its signal over n, and twice their difference; null until the signal starts."""
    dif = ema(x, fast, slow - 1) - ema(x, slow)
    dea = np.full(len(x), np.nan)
    if len(x) > slow - 1:
        dea[slow - 1 :] = ema(dif[slow - 1 :], n)
    dif = np.where(np.isnan(dea), np.nan, dif)
    return dif, dea, 2 * (dif - dea)


def rsi(x: np.ndarray, n: int) -> np.ndarray:
    change = np.diff(x, prepend=x[:1])
    up, down = np.maximum(change, 0), np.maximum(-change, 0)
    if len(x) <= n:
        return np.full(len(x), np.nan)
    u, d = (smoothed(v, n, v[1 : n + 1].mean(), 1 / n) for v in (up, down))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(np.isnan(u), np.nan, np.where(u + d == 0, 0.0, 100 * u / (u + d)))


def adx(high: np.ndarray, low: np.ndarray, close: np.ndarray, n: int) -> np.ndarray:
    size = len(close)
    if size < 2 * n:
        return np.full(size, np.nan)
    up, down, before = np.diff(high, prepend=high[:1]), -np.diff(low, prepend=low[:1]), np.concatenate((close[:1], close[:-1]))
    plus, minus = np.where((up > down) & (up > 0), up, 0.0), np.where((down > up) & (down > 0), down, 0.0)
    spread = np.maximum(high, before) - np.minimum(low, before)

    def wilder_sum(x: np.ndarray) -> np.ndarray:
        start = x[1:n].sum()
        return n * smoothed(x, n, (start - start / n + x[n]) / n, 1 / n)

    with np.errstate(invalid="ignore", divide="ignore"):
        tr, p, m = wilder_sum(spread), wilder_sum(plus), wilder_sum(minus)
        p, m = np.where(tr == 0, 0, p / tr), np.where(tr == 0, 0, m / tr)
        dx = np.where(p + m == 0, 0, 100 * np.abs(p - m) / (p + m))
    return smoothed(dx, 2 * n - 1, dx[n : 2 * n].mean(), 1 / n)


def from_first(kernel: Callable, *xs: np.ndarray):
    """The kernel on the rows from the first on where all of xs are known; null before. Later gaps are not mended."""
    known = ~np.isnan(np.vstack(xs)).any(axis=0)
    start = int(known.argmax()) if known.any() else len(known)
    found = kernel(*(x[start:] for x in xs))
    pad = lambda x: np.concatenate((np.full(start, np.nan), x))
    return tuple(map(pad, found)) if isinstance(found, tuple) else pad(found)


@dataclass(frozen=True)
class Recursions:
    """The recursive features of one value: lags of each kind, and the prefix of their names. ADX reads high, low and close."""

    value: str = "close"
    prefix: str = ""
    ema: tuple[int, ...] = ()
    macd: tuple[int, ...] = ()
    rsi: tuple[int, ...] = ()
    adx: tuple[int, ...] = ()

    @property
    def inputs(self) -> list[str]:
        return [self.value, *(("high", "low", "close") if self.adx else ())]

    @property
    def names(self) -> list[str]:
        p = self.prefix
        macds = [f"{p}MACD_DIF_12_26D"] * bool(self.macd) + [f"{p}MACD_{x}12_26_{n}D" for n in self.macd for x in ("DEA_", "")]
        return [*(f"{p}EMA_{n}D" for n in self.ema), *macds, *(f"{p}RSI_{n}D" for n in self.rsi), *(f"{p}ADX_{n}D" for n in self.adx)]

    def only(self, names: set[str]) -> Recursions:
        """Those of a lag that is asked for; the difference of MACD comes with its first lag."""
        p = self.prefix
        macds = tuple(n for i, n in enumerate(self.macd) if names & {f"{p}MACD_DEA_12_26_{n}D", f"{p}MACD_12_26_{n}D"} or not i and f"{p}MACD_DIF_12_26D" in names)
        kept = lambda kind, lags: tuple(n for n in lags if f"{p}{kind}_{n}D" in names)
        return replace(self, ema=kept("EMA", self.ema), macd=macds, rsi=kept("RSI", self.rsi), adx=kept("ADX", self.adx))

    def columns(self, bars: Mapping) -> dict[str, np.ndarray]:
        """The features of one key's bars in order of date, in the order of names."""
        x = np.asarray(bars[self.value], float)
        found = [from_first(lambda v, n=n: ema(v, n), x) for n in self.ema]
        for i, n in enumerate(self.macd):
            dif, dea, hist = from_first(lambda v, n=n: macd(v, n), x)
            # The difference is that of the first lag.
            found += [dea, hist] if i else [dif, dea, hist]
        found += [from_first(lambda v, n=n: rsi(v, n), x) for n in self.rsi]
        found += [from_first(lambda h, low, c, n=n: adx(h, low, c, n), *(np.asarray(bars[c], float) for c in ("high", "low", "close"))) for n in self.adx]
        return dict(zip(self.names, found, strict=True))


def recursive_sets(df: DataFrame, sets: list[Recursions], key: str = "code", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, date, the columns of keep and the features of all sets, in one grouped kernel per key; null until a value's first known row."""
    names = [c for s in sets for c in s.names]

    def compute(bars: pd.DataFrame) -> pd.DataFrame:
        bars = bars.sort_values("date", kind="stable")
        found = {c: bars[c] for c in (key, "date", *keep)}
        for s in sets:
            found |= s.columns(bars)
        return pd.DataFrame(found)[[key, "date", *keep, *names]]

    needed = list(dict.fromkeys([key, "date", *keep, *(c for s in sets for c in s.inputs)]))
    schema = T.StructType([df.schema[key], df.schema["date"], *(df.schema[c] for c in keep), *(T.StructField(c, T.DoubleType()) for c in names)])
    found = df.select(*needed).groupBy(key).applyInPandas(compute, schema)
    # The kernels' not-a-number is null everywhere else.
    return found.select(key, "date", *keep, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in names])


def recursive_features(df: DataFrame, *, key: str = "code", value: str = "close", ema_lags: tuple[int, ...] = (), macd_lags: tuple[int, ...] = (), rsi_lags: tuple[int, ...] = (), adx_lags: tuple[int, ...] = (), prefix: str = "", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, date, the columns of keep and the asked EMA, MACD, RSI and ADX columns of one value."""
    return recursive_sets(df, [Recursions(value, prefix, ema_lags, macd_lags, rsi_lags, adx_lags)], key, keep)
