"""Order statistics over sliding windows (D25, D26): one grouped kernel per key, all windows at once.

A frame of a SQL window sorts its values again at every row. Here each window length has a sorted list into which a row puts its value
and from which it takes the one that leaves, so a row costs two searches a length; all lengths share one exchange.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.operators.rolling import Rows


def sliding_median(x: np.ndarray, n: int) -> np.ndarray:
    """The median of the last n values; not a number until there are n, and where one of them isn't a number."""
    out, held, unknown = np.full(len(x), np.nan), [], 0
    values, missing = x.tolist(), np.isnan(x).tolist()
    for i, v in enumerate(values):
        if i >= n:
            if missing[i - n]:
                unknown -= 1
            else:
                del held[bisect_left(held, values[i - n])]
        if missing[i]:
            unknown += 1
        else:
            insort(held, v)
        if i >= n - 1 and not unknown:
            out[i] = (held[n // 2] + held[(n - 1) // 2]) / 2
    return out


def sliding_product(x: np.ndarray, n: int) -> np.ndarray:
    """The product of the last n values, not a number as above."""
    out = np.full(len(x), np.nan)
    if len(x) >= n:
        out[n - 1 :] = np.lib.stride_tricks.sliding_window_view(x, n).prod(axis=1)
    return out


def _change(x: np.ndarray, n: int) -> np.ndarray:
    out = np.full(len(x), np.nan)
    out[n:] = np.where(x[:-n] == 0, np.nan, x[n:] / x[:-n] - 1)
    return out


def price_volume(df: DataFrame, rows: Rows, lags: tuple[int, ...]) -> DataFrame:
    """PV_n and Market_Insight_n beside the columns of df.

    PV_n is RET_n times the product over n rows of amount to its median over n + 1 rows; Market_Insight_n is RET_1 over
    today's ratio, in percent. A null in a window gives null, and so does a division by zero. A key's history is one group.
    """
    names = [f"{c}_{n}D" for n in lags for c in ("PV", "Market_Insight")]
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.DoubleType()) for c in names)])

    def compute(bars: pa.Table) -> pa.Table:
        bars = bars.sort_by(rows.order)
        close, amount = (bars.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("close", "amount"))
        with np.errstate(invalid="ignore", divide="ignore"):
            day = _change(close, 1)
            for n in lags:
                middle = sliding_median(amount, n + 1)
                ratio = np.where(middle == 0, np.nan, amount / middle)
                for name, v in ((f"PV_{n}D", _change(close, n) * sliding_product(ratio, n)), (f"Market_Insight_{n}D", np.where(ratio == 0, np.nan, day / ratio * 100))):
                    bars = bars.append_column(name, pa.array(v, pa.float64(), from_pandas=True))
        return bars

    return df.groupBy(*[F.col(k) for k in rows.key]).applyInArrow(compute, schema)
