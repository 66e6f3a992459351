"""Index timing: turning points, bins and profit and loss."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantloom.operators.slices import below
from quantloom.sources.io import kept
from pyspark.sql import types as T

#: Upper 5 % point of the chi-squared distribution with one degree of freedom.
CHI2 = 3.841458820694124


def _turn(close: np.ndarray, begin: int, pct: float, threshold: float, peak: bool) -> int | None:
    """The next extreme from begin on: the best point so far when the move back is large enough, absolutely and against the move there."""
    sign = 1.0 if peak else -1.0
    best = begin
    for i in range(begin, len(close)):
        if sign * (close[i] - close[best]) > 0:
            best = i
        gone = sign * (close[best] / close[begin] - 1)
        back = sign * (1 - close[i] / close[best])
        # Without a move there yet, any large enough move back counts: the first extreme may be the first row.
        if back > threshold and (gone == 0 or back / gone > pct):
            return best
    return None


def turning_points(close: np.ndarray, pct: float, threshold: float) -> np.ndarray:
    """1 up to a peak, -1 up to a trough, each label filled backwards; all null without a first peak and a first trough."""
    out = np.full(len(close), np.nan)
    peak, trough = (_turn(close, 0, pct, threshold, p) for p in (True, False))
    if peak is None or trough is None or peak == trough:
        return out
    at, next_peak = (peak, False) if peak < trough else (trough, True)
    marks = {at: -1.0 if next_peak else 1.0}
    while True:
        found = _turn(close, at, pct, threshold, next_peak)
        marks[len(close) - 1 if found is None else found] = 1.0 if next_peak else -1.0
        if found is None:
            break
        at, next_peak = found, not next_peak
    begin = 0
    for i in sorted(marks):
        out[begin : i + 1] = marks[i]
        begin = i + 1
    return out


def label_turns(series: DataFrame, grid: DataFrame, key: str = "series_id") -> DataFrame:
    """H1: the labels and gross returns of each series for each row (chg_pct, chg_threshold) of a small grid; one group per series and setting."""

    def walk(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("date", kind="stable")
        label = turning_points(g["close"].to_numpy(float), float(g["chg_pct"].iloc[0]), float(g["chg_threshold"].iloc[0]))
        return g.assign(label=pd.array(label).astype("Int32"), ret=g["close"] / g["close"].shift(1))[[key, "chg_pct", "chg_threshold", "date", "ret", "label"]]

    schema = T.StructType([series.schema[key], *T.StructType.fromDDL("chg_pct double, chg_threshold double, date date, ret double, label int").fields])
    found = series.select(key, "date", "close").crossJoin(F.broadcast(grid)).groupBy(key, "chg_pct", "chg_threshold").applyInPandas(walk, schema)
    return found.withColumn("ret", F.when(~F.isnan("ret"), F.col("ret")))


def next_day_target(df: DataFrame, key: list[str], label: str = "label") -> DataFrame:
    """H2: the next row's label, -1 as 0; rows without one go."""
    nxt = F.lead(label).over(Window.partitionBy(*key).orderBy("date"))
    return df.withColumn("target", F.when(nxt == -1, 0).otherwise(nxt)).where("target IS NOT NULL")


def _chi2(a: np.ndarray, b: np.ndarray) -> float:
    """Of two bins (good, bad); 0 if either class is empty in both."""
    o = np.array([a, b], float).T
    if (o.sum(axis=1) == 0).any():
        return 0.0
    e = o.sum(axis=1, keepdims=True) * o.sum(axis=0, keepdims=True) / o.sum()
    return float(((o - e) ** 2 / e).sum())


def merged_bins(bounds: list[float], good: list[float], bad: list[float], level: float = CHI2) -> list[float]:
    """Upper bounds left when empty bins join a neighbour and then neighbours that don't differ are merged, from the lowest on."""
    ups, n = list(bounds), [np.array(x, float) for x in zip(good, bad, strict=True)]

    def join(i: int) -> None:
        n[i : i + 2] = [n[i] + n[i + 1]]
        del ups[i]

    i = 0
    while i < len(n) and len(n) > 1:
        if n[i].sum():
            i += 1
        elif i == 0:
            join(0)
        elif i == len(n) - 1:
            join(i - 1)
        else:
            before, after = (n[j][1] / n[j].sum() if n[j].sum() else 0.0 for j in (i - 1, i + 1))
            join(i - 1 if before > after else i)
            i = max(0, i - 1)
    i = 0
    while i < len(n) - 1:
        if _chi2(n[i], n[i + 1]) <= level:
            join(i)
            i = max(0, i - 1)
        else:
            i += 1
    return ups


def value_counts(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Each column's distinct values (column, v) with their rows n and those of the target, bad."""
    long = df.select(target, *[F.col(c).cast("double").alias(c) for c in columns]).where(F.col(target).isNotNull()).unpivot([target], columns, "column", "v").where("v IS NOT NULL")
    return long.groupBy("column", "v").agg(F.count("*").alias("n"), F.sum(target).alias("bad"))


def quantile_cuts(counted: DataFrame, bins: int = 100) -> DataFrame:
    """H4: the distinct midpoint quantiles (column, upper) of each column, at 1 / bins to 1, of values with their counts n.

    A value holds the ranks from the rows below it on; it is sent to the few quantiles whose ranks may be among these.
    """
    ranked = below(counted, ["column"], "v", ["n"]).withColumnsRenamed({"below_n": "from", "all_n": "all"}).withColumn("upto", F.col("from") + F.col("n"))
    step = lambda rank: rank * bins / F.greatest(F.col("all") - 1, F.lit(1))
    first, last = F.greatest(F.floor(step(F.col("from") - 1)), F.lit(1)), F.least(F.ceil(step(F.col("upto"))), F.lit(bins))
    steps = ranked.select("column", "v", "from", "upto", "all", F.explode(F.sequence(first, F.greatest(first, last))).alias("q"))
    at = (F.col("all") - 1) * F.col("q") / bins
    low, high = F.floor(F.round(at, 9)), F.ceil(F.round(at, 9))
    inside = lambda x: (x >= F.col("from")) & (x < F.col("upto"))
    sides = steps.where(inside(low) | inside(high)).groupBy("column", "q").agg(((F.max(F.when(inside(low), F.col("v"))) + F.max(F.when(inside(high), F.col("v")))) / 2).alias("upper"))
    return sides.select("column", "upper").distinct()


def chi_merge(df: DataFrame, columns: list[str], target: str, bins: int = 100) -> DataFrame:
    """H4: cut points (column, position, upper) of each column: midpoint quantiles, then merging on their counts of the target.

    Spark counts good and bad rows per bin; only these counts, at most bins + 1 per column, meet in a group.
    """
    # Written, as they are read for the quantiles and for the bins.
    counted = kept(value_counts(df, columns, target), "counted")
    uppers = quantile_cuts(counted, bins).groupBy("column").agg(F.sort_array(F.collect_list("upper")).alias("ups"))
    binned = counted.join(F.broadcast(uppers), "column").withColumn("bin", F.size(F.filter("ups", lambda u: u < F.col("v"))))
    per_bin = binned.groupBy("column", "bin").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def merge(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ups = [*right["ups"].iloc[0], float("inf")]
        n, bad = np.zeros(len(ups)), np.zeros(len(ups))
        n[left["bin"]], bad[left["bin"]] = left["n"], left["bad"]
        kept = merged_bins(ups, list(n - bad), list(bad))
        return pd.DataFrame({"column": key[0], "position": range(len(kept)), "upper": kept})

    # The same column by another name, as both sides come from one table.
    named = uppers.select(F.col("column").alias("of"), "ups")
    return per_bin.groupBy("column").cogroup(named.groupBy("of")).applyInPandas(merge, "column string, position int, upper double")


def assigned_bins(df: DataFrame, cuts: DataFrame, columns: list[str]) -> DataFrame:
    """H5: one-hot of each column's bins (right-closed); columns with a single bin go; null and values beyond the last cut are in none.

    Cut points are written, then joined as one row of arrays, at most a hundred and one per column; the driver only gets how many each column has,
    as they name the flags.
    """
    cuts = kept(cuts, "cuts")
    bins = {r["column"]: r["count"] for r in cuts.groupBy("column").count().collect()}
    flagged = [c for c in columns if bins.get(c, 0) > 1]
    if not flagged:
        return df.drop(*columns)
    ups = cuts.agg(*[F.sort_array(F.collect_list(F.when(F.col("column") == c, F.col("upper")))).alias(f"__ups_{c}") for c in flagged])
    below_value = lambda c: F.size(F.filter(f"__ups_{c}", lambda u: u < F.col(c)))
    out = df.crossJoin(F.broadcast(ups)).withColumns({f"__bin_{c}": below_value(c) for c in flagged})
    flags = {f"{c}_bin_{i}": F.coalesce((F.col(c).isNotNull() & (F.col(f"__bin_{c}") == i)).cast("int"), F.lit(0)) for c in flagged for i in range(bins[c])}
    return out.withColumns(flags).drop(*columns, *[f"__{k}_{c}" for c in flagged for k in ("ups", "bin")])


def timing_profit(df: DataFrame, key: list[str], signal: str, *, at_least: int = 1) -> DataFrame:
    """The day's gross return if yesterday's signal says so, else 1, and the product of all days so far."""
    w = Window.partitionBy(*key).orderBy("date")
    day = F.when(F.lag(signal).over(w) >= at_least, F.coalesce("ret", F.lit(1.0))).otherwise(1.0)
    return df.withColumn("day_return", day).withColumn("cumulative", F.product("day_return").over(w.rowsBetween(Window.unboundedPreceding, 0)))
