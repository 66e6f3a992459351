"""Fiscal report features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def year_on_year(df: DataFrame, accounts: list[str], supplied: dict[str, str] | None = None) -> DataFrame:
    """percent change to the same period a year before; where a supplied column knows it, that stays."""
    before = df.select("code", (F.col("period") + 100).alias("period"), *[F.col(a).alias(f"__{a}") for a in accounts])
    j = df.join(before, ["code", "period"], "left")
    change = {a: (F.try_divide(F.col(a), F.col(f"__{a}")) - 1) * 100 for a in accounts}
    return j.withColumns({f"{a}_yoy": F.coalesce((supplied or {})[a], c) if a in (supplied or {}) else c for a, c in change.items()}).drop(*[f"__{a}" for a in accounts])


def trailing_year(df: DataFrame, accounts: list[str]) -> DataFrame:
    """the last four quarters of accounts that add up within a year; null if a part is missing."""
    same = df.select("code", (F.col("period") + 100).alias("period"), *[F.col(a).alias(f"__s_{a}") for a in accounts])
    whole = df.where("fiscal_season = 4").select("code", (F.col("fiscal_year") + 1).alias("fiscal_year"), *[F.col(a).alias(f"__w_{a}") for a in accounts])
    j = df.join(same, ["code", "period"], "left").join(whole, ["code", "fiscal_year"], "left")
    return j.withColumns({f"{a}_ttm": F.when(F.col("fiscal_season") == 4, F.col(a)).otherwise(F.col(a) + F.col(f"__w_{a}") - F.col(f"__s_{a}")) for a in accounts}).drop(*[f"__{k}_{a}" for k in "sw" for a in accounts])


def daily_reports(reports: DataFrame, calendar: DataFrame, columns: list[str], today) -> DataFrame:
    """on each trade day the newest report in force.

    A missing release date takes that of the next report in period order, the last one today's. A report is in force
    from its release until that of the next period; of several on a day the highest period counts.
    """
    ahead = Window.partitionBy("code").orderBy("period").rowsBetween(0, Window.unboundedFollowing)
    released = reports.withColumn("__from", F.coalesce(F.first("report_date", ignorenulls=True).over(ahead), F.lit(today).cast("date")))
    spans = released.withColumn("__to", F.lead("__from").over(Window.partitionBy("code").orderBy("period")))
    days = F.broadcast(calendar.select("date"))
    daily = spans.join(days, (F.col("date") >= F.col("__from")) & (F.col("__to").isNull() | (F.col("date") < F.col("__to"))))
    return daily.withColumn("__n", F.row_number().over(Window.partitionBy("code", "date").orderBy(F.desc("period")))).where("__n = 1").select("date", "code", "period", *columns)


def highest_period(df: DataFrame) -> DataFrame:
    """of several rows of a code and date the one with the highest period."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy("code", "date").orderBy(F.desc("period")))).where("__n = 1").drop("__n")


def unchanged_codes(daily: DataFrame, updated: DataFrame, new_dates: DataFrame) -> DataFrame:
    """codes without a new report keep their last row on each new trade day. new_dates is small."""
    last = daily.join(updated.select("code").distinct(), "code", "left_anti").withColumn("__n", F.row_number().over(Window.partitionBy("code").orderBy(F.desc("date")))).where("__n = 1").drop("__n")
    days = F.broadcast(new_dates.select(F.col("date").alias("__new")))
    return last.join(days, F.col("__new") > F.col("date")).withColumn("date", F.col("__new")).drop("__new")
