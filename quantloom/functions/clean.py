"""Scalar cleaning of vendor text (B1-B7, B17, F3, H3), as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(v: Column | str) -> Column:
    return F.col(v) if isinstance(v, str) else v


def renamed_and_cast(df: DataFrame, names: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    """B1: renames columns, then casts some of them; what can't be cast is null."""
    out = df.withColumnsRenamed(names)
    return out.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items()})


def nan_inf_to_null(v: Column | str) -> Column:
    return F.when(~(F.isnan(_c(v)) | F.abs(_c(v)).eqNullSafe(F.lit(float("inf")))), _c(v))


def chinese_number(v: Column | str) -> Column:
    """B2: `1.2亿` is 1.2e8, `3万` is 3e4, anything else a plain number or null."""
    number = F.regexp_extract(_c(v), r"^([-+0-9.]+)[亿万]$", 1).try_cast("double")
    return F.when(_c(v).endswith("亿"), number * 100000000).when(_c(v).endswith("万"), number * 10000).otherwise(_c(v).try_cast("double"))


def sentinel_number(v: Column | str) -> Column:
    """`-` is 0; `null`, `--` and an empty text are null."""
    return F.when(_c(v) == "-", F.lit(0.0)).when(~_c(v).isin("null", "--", ""), _c(v).try_cast("double"))


def percent_number(v: Column | str) -> Column:
    """`3.2%` is 0.032, `1,234` is 1234."""
    plain = F.regexp_replace(_c(v), "[,%]", "").try_cast("double")
    return F.when(_c(v).endswith("%"), plain / 100).otherwise(plain)


def date_text(v: Column | str) -> Column:
    """yyyyMMdd, yyyy年M月d日, or an ISO date with or without a time of day."""
    v = _c(v)
    parts = [F.regexp_extract(v, r"^(\d{4})年(\d{1,2})月(\d{1,2})日", i).try_cast("int") for i in (1, 2, 3)]
    return F.when(v.rlike(r"^\d{8}$"), F.try_to_date(v, "yyyyMMdd")).when(v.rlike("^\\d{4}年"), F.make_date(*parts)).otherwise(F.try_to_date(F.substring(v, 1, 10), "yyyy-MM-dd"))


def us_session_date(v: Column | str) -> Column:
    """The day before: a session that ends in the local morning."""
    return F.date_sub(date_text(v), 1)


def bare_code(v: Column | str) -> Column:
    """The part before the dot of a vendor code."""
    return F.substring_index(_c(v), ".", 1)


def is_b_share(code: Column | str) -> Column:
    return _c(code).startswith("9")


def market_of(code: Column | str) -> Column:
    """Market by code prefix."""
    c = _c(code)
    return F.when(c.startswith("60"), "SH").when(c.startswith("002"), "SMEB").when(c.startswith("300"), "GEB").otherwise("SZ")


def repaired_report_date(date: Column | str, period_end: Column | str, today: Column | str) -> Column:
    """A year later or earlier if that brings the date between the period's end and today, else null."""
    d, end, now = _c(date), _c(period_end), _c(today)
    fits = lambda x: (x >= end) & (x <= now)
    later, earlier = F.add_months(d, 12), F.add_months(d, -12)
    return F.when(fits(d), d).when(fits(later), later).when(fits(earlier), earlier)


def announced_month(year: Column | str, month: Column | str) -> Column:
    """Monthly figures are known on the 15th of the next month."""
    return F.date_add(F.add_months(F.make_date(_c(year), _c(month), F.lit(1)), 1), 14)


def announced_season(year: Column | str, season: Column | str) -> Column:
    """Quarterly figures are known on the 15th after the quarter; the fourth quarter's in the next year."""
    return F.date_add(F.add_months(F.make_date(_c(year), F.lit(1), F.lit(1)), 3 * _c(season)), 14)


def cash_dividend(text: Column | str) -> Column:
    """the cash part of a dividend text such as `10派1.6转2`."""
    return F.regexp_extract(_c(text), "派([0-9.]+)", 1).try_cast("double")


def notch(ret: Column | str, bounds: tuple[float, ...] = (0.97, 0.98, 0.99, 1.0, 1.01, 1.02, 1.03)) -> Column:
    """H3: index of the first bound that the return doesn't pass, else their number; null for null."""
    out = F.when(_c(ret) <= bounds[0], 0)
    for i, b in enumerate(bounds[1:], 1):
        out = out.when(_c(ret) <= b, i)
    return F.when(_c(ret).isNotNull(), out.otherwise(len(bounds)))
