"""Cleaning of panels and dimensions by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def named_markets(index: DataFrame, names: dict[str, str], benchmark: str) -> tuple[DataFrame, DataFrame]:
    """Market index rows under their names, and the benchmark's rows apart."""
    name = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return index.where(F.col("code").isin(list(names))).withColumn("market", name[F.col("code")]).drop("code"), index.where(F.col("code") == benchmark).drop("code")


def first_by_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in a stated order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def adjusted_quotes(quotes: DataFrame, factors: DataFrame, scaled: tuple[str, ...] = ("open", "high", "low", "close", "amount")) -> DataFrame:
    """Quotes times their adjustment factor."""
    return quotes.join(factors, ["date", "code"]).withColumns({c: F.col(c) * F.col("adj_factor") for c in scaled}).drop("adj_factor")


def with_turnover(quotes: DataFrame, second: DataFrame) -> DataFrame:
    """Turnover from a second source; a left join in full and incremental loads alike."""
    return quotes.drop("turnover").join(second.select("date", "code", "turnover"), ["date", "code"], "left")


def on_trade_days(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """B12."""
    return df.join(F.broadcast(calendar.select("date")), "date", "left_semi")


def member_flags(df: DataFrame, members: dict[str, DataFrame]) -> DataFrame:
    """A 0/1 column per member list keyed (date, code)."""
    for name, m in members.items():
        df = df.join(m.select("date", "code").distinct().withColumn(name, F.lit(1)), ["date", "code"], "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return df


def merged_sources(a: DataFrame, b: DataFrame, key: list[str], columns: list[str], *, left_wins: list[str], tolerance: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Rows of a with b's values where a has none, or everywhere but in left_wins; and per column the number of rows that differ by more than the tolerance."""
    j = a.join(b.select(*key, *[F.col(c).alias(f"__{c}") for c in columns]), key, "left")
    report = j.agg(*[F.count_if(F.abs(F.col(c) - F.col(f"__{c}")) > tolerance).alias(c) for c in columns])
    pick = lambda c: F.coalesce(c, f"__{c}") if c in left_wins else F.coalesce(f"__{c}", c)
    return j.withColumns({c: pick(c) for c in columns}).drop(*[f"__{c}" for c in columns]), report


def fill_upsert(existing: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Existing rows take new values where they have none, unseen keys are added; touched tells which rows changed."""
    j = existing.select(*key, *columns, F.lit(1).alias("__old")).join(new.select(*key, *[F.col(c).alias(f"__{c}") for c in columns]), key, "full")
    filled = F.lit(False)
    for c in columns:
        filled = filled | (F.col(c).isNull() & F.col(f"__{c}").isNotNull())
    return j.select(*key, *[F.coalesce(c, f"__{c}").alias(c) for c in columns], (F.col("__old").isNull() | filled).alias("touched"))


def supplemented_valuation(source: DataFrame, cap: DataFrame, reports: DataFrame) -> DataFrame:
    """PE from cap over trailing profit and PS from close over trailing sales, for keys that the source lacks.

    cap holds cap and close, reports profit_ttm and sales_ttm; a key that only one of them has gets what that allows.
    """
    both = cap.join(reports, ["date", "code"], "full")
    derived = both.select("date", "code", F.try_divide("cap", "profit_ttm").alias("PE_TTM"), F.try_divide("close", "sales_ttm").alias("PS_TTM")).where("PE_TTM IS NOT NULL OR PS_TTM IS NOT NULL")
    return source.select("date", "code", "PE_TTM", "PS_TTM").unionByName(derived.join(source.select("date", "code"), ["date", "code"], "left_anti"))


def carried_forward(series: DataFrame, calendar: DataFrame, columns: list[str], key: str = "series_id") -> DataFrame:
    """On each trade day of the calendar the series' row, or the nearest one before it. Days before a key's first row are left out."""
    keys = series.groupBy(key).agg(F.min("date").alias("__first"))
    spine = F.broadcast(calendar.select("date")).crossJoin(keys).where("date >= __first").drop("__first")
    w = Window.partitionBy(key).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return spine.join(series.select(key, "date", *columns), [key, "date"], "left").withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def known_daily(values: DataFrame, calendar: DataFrame, columns: list[str], announced: str = "announced") -> DataFrame:
    """A low-frequency series on each trade day from its announcement to the next; of one day's announcements the last in order counts."""
    following = F.lead(announced).over(Window.orderBy(announced, *columns))
    spans = values.select(announced, *columns).withColumn("__to", following)
    days = F.broadcast(calendar.select("date"))
    return days.join(F.broadcast(spans), (F.col("date") >= F.col(announced)) & (F.col("__to").isNull() | (F.col("date") < F.col("__to")))).select("date", *columns)


def joined_daily(sources: list[tuple[DataFrame, list[str]]], calendar: DataFrame) -> DataFrame:
    """Several low-frequency sources (each with its columns) on each trade day that any of them covers."""
    out = None
    for values, columns in sources:
        one = known_daily(values, calendar, columns)
        out = one if out is None else out.join(one, "date", "full")
    return out


def month_span(months: DataFrame, columns: list[str]) -> DataFrame:
    """Each month's figures on every day from the 15th of the next month to the 14th of the one after."""
    start = F.date_add(F.add_months(F.make_date("year", "month", F.lit(1)), 1), 14)
    return months.select(F.explode(F.sequence(start, F.date_sub(F.add_months(start, 1), 1))).alias("date"), *columns)


def code_ranges(df: DataFrame) -> DataFrame:
    """First and last date of each code."""
    return df.groupBy("code").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def not_loaded(codes: DataFrame, loaded: DataFrame) -> DataFrame:
    return codes.select("code").join(loaded.select("code"), "code", "left_anti")
