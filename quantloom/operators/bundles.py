"""Feature sets of one value and the bundles made of them (D4-D6, D20, D21, D23), from one configuration.

A bundle is planned as a whole: its few inputs are sorted by key and date and numbered, histories are put together to batches of some ten
thousand rows, and one grouped kernel adds all features to a batch. So inputs are exchanged twice, and features, up to 380 columns, never are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.operators.histories import Histories, divided, rounded
from quantloom.operators.recursive import Recursions
from quantloom.operators.rolling import Rows

L7 = (1, 2, 5, 10, 20, 30, 60)
BANDS = (7, 14, 21, 28)
AVERAGES = ("MA", "EMA", "WMA")
#: Rows of a batch of histories; the last history may go beyond.
BATCH = 16384
BAR = ("open", "high", "low", "close", "volume", "amount", "turnover")


@dataclass(frozen=True)
class ValueSet:
    """The features of one value: the prefix of their names, lags, and which kinds; differences are taken from the averages."""

    value: str = "close"
    prefix: str = ""
    lags: tuple[int, ...] = L7
    averages: bool = True
    differences: bool = True
    returns: bool = True
    spreads: bool = True
    macd: tuple[int, ...] = BANDS

    @property
    def long_lags(self) -> tuple[int, ...]:
        """A row's average with itself alone is no feature."""
        return tuple(n for n in self.lags if n >= 2)


@dataclass(frozen=True)
class Bundle:
    """What a bundle holds beside its value sets.

    to_average: (value, name) of the ratios name_TO_MA_n; balances: (value, name) of signed sums name_n; ratios: (value, pattern of
    the name, lags) of values over their averages; bars: the features of whole bars; sums: turnover sums and amplitudes;
    filled: gaps take the last known value first, and stay null before it.
    """

    sets: tuple[ValueSet, ...] = ()
    lags: tuple[int, ...] = L7
    bars: bool = False
    sums: bool = False
    to_average: tuple[tuple[str, str], ...] = ()
    balances: tuple[tuple[str, str], ...] = ()
    ratios: tuple[tuple[str, str, tuple[int, ...]], ...] = ()
    filled: bool = False

    @property
    def inputs(self) -> list[str]:
        needed = {s.value for s in self.sets} | {v for v, *_ in (*self.to_average, *self.balances, *self.ratios)}
        needed |= ({"high", "low", "close", "volume"} if self.bars else set()) | ({"high", "low", "close", "turnover"} if self.sums else set()) | ({"close"} if self.balances else set())
        return [c for c in BAR if c in needed] + sorted(needed - set(BAR))


PRICE, VOLUME, AMOUNT = ValueSet(), ValueSet("volume", "V"), ValueSet("amount", "AMT")
_VOLUME = {"balances": (("volume", "OBV_DIFF"),), "ratios": (("volume", "VOLUME_RATIO", (5,)),)}
_AMOUNT = {"balances": (("amount", "AMT_OBV_DIFF"),), "ratios": (("amount", "AMOUNT_RATIO_{}D", AMOUNT.long_lags),)}
BUNDLES = {
    "price": Bundle((PRICE, VOLUME), bars=True, sums=True, **_VOLUME),
    "stationary": Bundle((AMOUNT,), to_average=(("close", "PRICE"),), **_AMOUNT),
    "series": Bundle((PRICE, VOLUME), bars=True, filled=True, **_VOLUME),
    "close_only": Bundle((PRICE,)),
    "ratio_only": Bundle(to_average=(("close", "PRICE"),)),
    "series_stationary": Bundle((AMOUNT,), to_average=(("close", "PRICE"),), filled=True, **_AMOUNT),
}


Features = dict[str, Callable[[], np.ndarray]]
#: By the name of a feature: digits and shift, or None where it stays as it is.
Shown = Callable[[str], tuple[int, float] | None]


def _of_value(h: Histories, s: ValueSet) -> Features:
    """Averages, returns, deviations and bands; differences from averages, their sign, its counts over the lag, and its runs.

    Differences are rounded to a millionth before their sign is taken, as an average of equal values may miss them by a hair.
    """
    x, p, out = h[s.value], s.prefix, {}
    means: Features = {f"{p}MA_{n}D": lambda n=n: h.mean(x, n) for n in s.long_lags} | {f"{p}WMA_{n}D": lambda n=n: h.weighted(x, n) for n in s.long_lags}
    if s.averages:
        out |= means
    if s.returns:
        out |= {f"{p}RET_{n}D": lambda n=n: h.change(x, n) for n in s.lags}
    if s.spreads:
        out |= {f"{p}STD_{n}D": lambda n=n: h.deviation(x, n, sample=True) for n in s.long_lags if n >= 5}
        band = lambda n, width: h.mean(x, n) + width * h.once(f"__dev_{s.value}_{n}", lambda: h.deviation(x, n))
        out |= {f"{p}BBANDS_{side}_{n}D": lambda n=n, width=width: band(n, width) for n in BANDS for side, width in (("UPPER", 2.0), ("LOWER", -2.0))}
    for k, n in ((f"{p}{k}", n) for k in AVERAGES for n in s.long_lags if s.differences):
        d, sign = f"{k}_DIFF_{n}D", f"{k}_DIFF_SIGN_{n}D"
        # Exponential averages are held by their name already.
        average = lambda k=k, n=n: h.once(f"{k}_{n}D", means.get(f"{k}_{n}D"))
        out[d] = lambda average=average: np.round(x - average(), 6)
        out[sign] = lambda d=d: np.where(np.isnan(h.once(d, out[d])), np.nan, h[d] > 0)
        plus = lambda sign=sign, n=n: h.once(f"__plus_{sign}", lambda: h.total(h.once(sign, out[sign]), n))
        out |= {f"{k}_DIFF_PLUS_COUNT_{n}D": plus, f"{k}_DIFF_NEGATIVE_COUNT_{n}D": lambda n=n, plus=plus: n - plus()}
        out |= {f"{k}_DIFF_CON_{side}_COUNT_{n}D": lambda sign=sign, value=value: h.run(h.once(sign, out[sign]) == value) for side, value in (("PLUS", 1), ("NEGATIVE", 0))}
    return out


def _of_bars(h: Histories) -> Features:
    """D11, D13, D15-D17 over all bands."""
    high, low, close, out = h["high"], h["low"], h["close"], {}
    before = h.lag(close, 1)
    top, bottom, typical = np.fmax(high, before), np.fmin(low, before), (high + low + close) / 3
    added = np.nan_to_num(divided(2 * close - high - low, high - low), nan=0.0) * h["volume"]

    def index(n: int) -> np.ndarray:
        spread = 0.015 * h.gaps(typical, n, np.abs)
        return np.where(np.isnan(spread), np.nan, np.nan_to_num(divided(typical - h.mean(typical, n), spread), nan=0.0))

    def place(n: int, part: np.ndarray) -> np.ndarray:
        """A part of the range of n rows, in percent; 0 where there is none."""
        return h.full(np.nan_to_num(divided(100 * part, h.once(f"__high{n}", lambda: h.highest(high, n)) - h.once(f"__low{n}", lambda: h.lowest(low, n))), nan=0.0), n)

    slow = lambda n: h.once(f"__slow{n}", lambda: h.mean(place(n, close - h.once(f"__low{n}", lambda: h.lowest(low, n))), 3))
    for n in BANDS:
        out |= {f"AD_DIFF_{n}D": lambda n=n: h.known_total(added, n), f"CCI_{n}D": lambda n=n: index(n), f"WILLER_{n}D": lambda n=n: place(n, close - h.once(f"__high{n}", lambda: h.highest(high, n)))}
        out[f"VR_{n}D"] = lambda n=n: divided(top - bottom, h.highest(top, n) - h.lowest(bottom, n))
        out[f"STOCH_D_{n}D"] = lambda n=n: h.mean(slow(n), 3)
        out[f"STOCH_K_{n}D"] = lambda n=n: np.where(np.isnan(h.mean(slow(n), 3)), np.nan, slow(n))
    return out


def _features(h: Histories, bundle: Bundle) -> Features:
    out: Features = {}
    for s in bundle.sets:
        out |= _of_value(h, s)
    if bundle.bars:
        out |= _of_bars(h)
    for v, name in bundle.to_average:
        out |= {f"{name}_TO_MA_{n}D": lambda v=v, n=n: divided(h[v], h.mean(h[v], n)) for n in bundle.lags if n >= 2}
    for v, name in bundle.balances:
        signed = lambda v=v: h.once(f"__signed_{v}", lambda: np.sign(h["close"] - h.lag(h["close"], 1)) * h[v])
        out |= {f"{name}_{n}D": lambda n=n, signed=signed: h.known_total(signed(), n) for n in bundle.lags}
    for v, name, lags in bundle.ratios:
        out |= {name.format(n): lambda v=v, n=n: divided(h[v], h.mean(h[v], n)) for n in lags}
    if bundle.sums:
        amplitude = lambda n: divided(h.full(h.over(np.maximum, h["high"], n, -np.inf) - h.over(np.minimum, h["low"], n, np.inf), n), h.lag(h["close"], n))
        out |= {f"TURNOVER_ROLLING_SUM_{n}D": lambda n=n: h.total(h["turnover"], n) for n in bundle.lags} | {f"AMPLITUDE_{n}D": lambda n=n: amplitude(n) for n in bundle.lags}
    return out


def batches(df: DataFrame, rows: Rows, most: int = BATCH) -> DataFrame:
    """df with row_number in its key and __batch, equal for whole histories of together about `most` rows."""
    numbered = df.withColumn("row_number", rows.number()).withColumn("__at", F.monotonically_increasing_id())
    dealt = numbered.withColumn("__batch", F.floor(F.min("__at").over(Window.partitionBy(*rows.key)) / most)).drop("__at")
    # A stated number of partitions: Spark would join them by the bytes that they hold, not knowing the hundreds of columns to come.
    return dealt.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__batch")


def counts(x: np.ndarray) -> pd.arrays.IntegerArray:
    unknown = np.isnan(x)
    return pd.arrays.IntegerArray(np.where(unknown, 0, x).astype(np.int64), unknown)


def bundle_features(df: DataFrame, rows: Rows, bundle: Bundle, only: tuple[str, ...] | None = None, shown: Shown = lambda _: None) -> DataFrame:
    """key, date and the bundle's features, or only some of them. df holds a row per key and date with the bundle's inputs.

    Values may be null before a key's first known one; later gaps need `filled`. Empty tables give no rows. shown tells the digits that a
    feature is rounded to and what is added before, or None.
    """
    key, inputs = rows.key[0], bundle.inputs
    base = df.select(key, "date", *[F.col(c).cast("double").alias(c) for c in inputs])
    if bundle.filled:
        base = base.withColumns({c: F.last(c, ignorenulls=True).over(rows.so_far) for c in inputs})
    kernels = [Recursions(s.value, s.prefix, ema=s.long_lags if s.averages else (), macd=s.macd) for s in bundle.sets]
    kernels += [Recursions(rsi=BANDS, adx=BANDS)] if bundle.bars else []
    recursive = [c for k in kernels for c in k.names]
    known = _features(Histories({c: np.zeros(0) for c in inputs}, np.zeros(0)), bundle)
    names = [c for c in dict.fromkeys([*recursive, *known]) if only is None or c in only]
    if not bundle.sets and not bundle.bars:
        return _native(base, rows, bundle, names, shown)
    # Only the recursions that are asked for, or that a difference needs.
    needed = {c for c in recursive if c in names or "EMA_" in c and any("EMA_DIFF_" in x for x in names)}
    kernels = [k for k in (k.only(needed) for k in kernels) if k.names]
    whole = lambda c: "_DIFF_SIGN_" in c or "_COUNT_" in c

    def compute(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.iloc[np.lexsort((batch["row_number"], pd.factorize(batch[key], use_na_sentinel=False)[0]))]
        columns, place = {c: batch[c].to_numpy(float) for c in inputs}, batch["row_number"].to_numpy() - 1
        bounds = [*np.flatnonzero(place == 0), len(place)]
        parts = [{c: v for k in kernels for c, v in k.columns({c: columns[c][a:b] for c in k.inputs}).items()} for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            h = Histories(columns | {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}, place)
            built = _features(h, bundle)
            values = {c: h.once(c, built.get(c)) for c in names}
            # Whole columns at a time; a row's hundreds of numbers would each be a decimal for Spark's round.
            values |= {c: rounded(values[c] + shift, digits) for c in names if (told := shown(c)) for digits, shift in [told]}
        found = {c: counts(v) if whole(c) else v for c, v in values.items()}
        return pd.DataFrame({key: batch[key].array, "date": batch["date"].array, **found})

    type_of = lambda c: T.IntegerType() if "_SIGN_" in c or "_CON_" in c else T.LongType() if whole(c) else T.DoubleType()
    schema = T.StructType([df.schema[key], df.schema["date"], *(T.StructField(c, type_of(c)) for c in names)])
    return batches(base, rows).groupBy("__batch").applyInPandas(compute, schema)


def _native(base: DataFrame, rows: Rows, bundle: Bundle, names: list[str], shown: Shown) -> DataFrame:
    """A bundle of ratios alone is a few columns over one window."""
    found = {f"{name}_TO_MA_{n}D": rows.to_mean(v, n) for v, name in bundle.to_average for n in bundle.lags if n >= 2}
    found |= {name.format(n): rows.to_mean(v, n) for v, name, lags in bundle.ratios for n in lags}
    out = base
    if bundle.balances:
        out = out.withColumn("__before", rows.lag("close"))
        found |= {f"{name}_{n}D": rows.obv_diff(v, n) for v, name in bundle.balances for n in bundle.lags}
    if bundle.sums:
        found |= {f"TURNOVER_ROLLING_SUM_{n}D": rows.rolling_sum("turnover", n) for n in bundle.lags} | {f"AMPLITUDE_{n}D": rows.amplitude(n) for n in bundle.lags}
    found |= {c: F.round(found[c] + told[1], told[0]) for c in names if (told := shown(c))}
    return out.select(rows.key[0], "date", *[found[c].alias(c) for c in names])


def value_set(df: DataFrame, rows: Rows, s: ValueSet, only: tuple[str, ...] | None = None, shown: Shown = lambda _: None) -> DataFrame:
    """key, date and the features of one value, or only some of them."""
    return bundle_features(df, rows, Bundle((s,)), only, shown)
