"""Window features per code, category or series.

All of them are columns over row frames of one window, so a bundle needs a single exchange by key. A frame gives null
until it is full of non-null values; divisions by zero give null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

Value = Column | str


def _c(v: Value) -> Column:
    return F.col(v) if isinstance(v, str) else v


@dataclass(frozen=True)
class Rows:
    """The rows of one key in order; key and order name columns."""

    key: tuple[str, ...] = ("code",)
    order: str = "date"

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.key).orderBy(self.order)

    def last(self, n: int) -> WindowSpec:
        return self.window.rowsBetween(1 - n, 0)

    @property
    def so_far(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, 0)

    def full(self, aggregate: Column, v: Value, n: int) -> Column:
        """aggregate over the last n rows if v isn't null in any of them."""
        return F.when(F.count(_c(v)).over(self.last(n)) == n, aggregate.over(self.last(n)))

    def lag(self, v: Value, n: int = 1) -> Column:
        return F.lag(_c(v), n).over(self.window)

    def number(self) -> Column:
        return F.row_number().over(self.window)

    # D1, D3, D7-D9
    def sma(self, v: Value, n: int) -> Column:
        return self.full(F.avg(_c(v)), v, n)

    def wma(self, v: Value, n: int, row: str = "row_number") -> Column:
        """Weights 1 to n, the newest heaviest; needs a column with the row's number."""
        total, weighted = F.sum(_c(v)).over(self.last(n)), F.sum(_c(v) * F.col(row)).over(self.last(n))
        return F.when(F.count(_c(v)).over(self.last(n)) == n, (weighted - (F.col(row) - n) * total) / (n * (n + 1) / 2))

    def ret(self, v: Value, n: int) -> Column:
        return F.try_divide(_c(v), self.lag(v, n)) - 1

    def std(self, v: Value, n: int) -> Column:
        return self.full(F.stddev_samp(_c(v)), v, n)

    def bbands(self, v: Value, n: int, width: float = 2.0) -> tuple[Column, Column]:
        """Upper and lower Bollinger band."""
        mid, dev = self.full(F.avg(_c(v)), v, n), self.full(F.stddev_pop(_c(v)), v, n)
        return mid + width * dev, mid - width * dev

    # D4-D6
    def sign(self, difference: Value) -> Column:
        return F.when(_c(difference) > 0, 1).when(_c(difference).isNotNull(), 0)

    def plus_count(self, sign: Value, n: int) -> Column:
        return self.full(F.sum(_c(sign)), sign, n)

    def run_lengths(self, df: DataFrame, sign: str, value: int, name: str) -> DataFrame:
        """How many rows in a row have had this sign; a key's first row counts as 0 whatever it has."""
        hit = F.coalesce(F.col(sign) == value, F.lit(False)) & (self.number() > 1)
        marked = df.withColumn("__hit", hit.cast("int")).withColumn("__run", F.sum(1 - F.col("__hit")).over(self.so_far))
        inside = Window.partitionBy(*self.key, "__run").orderBy(self.order).rowsBetween(Window.unboundedPreceding, 0)
        return marked.withColumn(name, F.sum("__hit").over(inside)).drop("__hit", "__run")

    # D11, D13, D15-D22
    def ad_diff(self, n: int) -> Column:
        """n-row difference of accumulation/distribution, a plain sum of what each row adds."""
        clv = F.coalesce(F.try_divide(2 * F.col("close") - F.col("high") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))
        return F.when(self.number() > n, F.sum(clv * F.col("volume")).over(self.last(n)))

    def cci(self, n: int) -> Column:
        typical = (F.col("high") + F.col("low") + F.col("close")) / 3
        mean = F.avg(typical).over(self.last(n))
        spread = F.aggregate(F.collect_list(typical).over(self.last(n)), F.lit(0.0), lambda a, x: a + F.abs(x - mean)) / n
        return F.when(F.count(typical).over(self.last(n)) == n, F.coalesce(F.try_divide(typical - mean, 0.015 * spread), F.lit(0.0)))

    def fast_k(self, n: int) -> Column:
        high, low = F.max("high").over(self.last(n)), F.min("low").over(self.last(n))
        return F.when(self.number() >= n, F.coalesce(F.try_divide(100 * (F.col("close") - low), high - low), F.lit(0.0)))

    def willr(self, n: int) -> Column:
        high, low = F.max("high").over(self.last(n)), F.min("low").over(self.last(n))
        return F.when(self.number() >= n, F.coalesce(F.try_divide(-100 * (high - F.col("close")), high - low), F.lit(0.0)))

    def true_high(self) -> Column:
        return F.greatest("high", self.lag("close"))

    def true_low(self) -> Column:
        return F.least("low", self.lag("close"))

    def rolling_sum(self, v: Value, n: int) -> Column:
        return self.full(F.sum(_c(v)), v, n)

    def amplitude(self, n: int) -> Column:
        return F.try_divide(self.full(F.max("high"), "high", n) - self.full(F.min("low"), "low", n), self.lag("close", n))

    def obv_diff(self, v: Value, n: int) -> Column:
        """n-row difference of the balance of v signed by the close's direction."""
        return F.when(self.number() > n, F.sum(F.signum(F.col("close") - F.col("__before")) * _c(v)).over(self.last(n)))

    def to_mean(self, v: Value, n: int) -> Column:
        return F.try_divide(_c(v), self.sma(v, n))


def stochastics(df: DataFrame, rows: Rows, n: int) -> DataFrame:
    """STOCH_K and STOCH_D: fast K smoothed over 3 rows, twice; both start at row n + 3 (from 0)."""
    out = df.withColumn("__fast", rows.fast_k(n)).withColumn("__slow", rows.sma("__fast", 3)).withColumn("__d", rows.sma("__slow", 3))
    return out.withColumn(f"STOCH_K_{n}D", F.when(F.col("__d").isNotNull(), F.col("__slow"))).withColumnRenamed("__d", f"STOCH_D_{n}D").drop("__fast", "__slow")


def volatility_ratio(df: DataFrame, rows: Rows, n: int) -> DataFrame:
    """VR: today's true range over the true range of up to n days."""
    out = df.withColumn("__h", rows.true_high()).withColumn("__l", rows.true_low())
    spread = F.max("__h").over(rows.last(n)) - F.min("__l").over(rows.last(n))
    return out.withColumn(f"VR_{n}D", F.try_divide(F.col("__h") - F.col("__l"), spread)).drop("__h", "__l")


def balance_volume(df: DataFrame, rows: Rows, v: str, lags: tuple[int, ...], name: str) -> DataFrame:
    out = df.withColumn("__before", rows.lag("close"))
    return out.withColumns({f"{name}_{n}D": rows.obv_diff(v, n) for n in lags}).drop("__before")


def betas(df: DataFrame, rows: Rows, asset: str, market: str, lags: tuple[int, ...], half_life: int = 63, block: int = 4096) -> DataFrame:
    """beta_n: decayed covariance over decayed variance around plain means, from row n on (from 0); values are finite or null.

    Sums run within blocks of rows, whose decay starts anew at each block, so that factors stay below 2**(block / half_life)
    however long a key is. A decayed sum of all rows so far is this one and what the end of the block before has left
    of its own (that of older blocks is under one part in 2**(block / half_life)); the sum over the last n rows is
    that of today less the decayed one of n rows ago, so all lags share the same sums.
    """
    if max(lags) > block or not 60 * half_life <= block <= 1000 * half_life:
        raise ValueError("a block holds 60 to 1,000 half-lives, and no window more than a block")
    a, m, decay = F.col(asset), F.col(market), lambda k: F.pow(F.lit(2.0), -k / half_life)
    out = df.withColumn("__row", rows.number()).withColumns({"__block": F.floor((F.col("__row") - 1) / block), "__r": (F.col("__row") - 1) % block})
    inside = Window.partitionBy(*rows.key, "__block").orderBy(rows.order).rowsBetween(Window.unboundedPreceding, 0)
    grown = {k: F.sum(x / decay(F.col("__r"))).over(inside) for k, x in {"a": a, "m": m, "am": a * m, "mm": m * m}.items()}
    plain = {k: F.sum(x).over(inside) for k, x in {"pa": a, "pm": m, "pn": F.when((a * m).isNotNull(), 1).otherwise(0)}.items()}
    out = out.withColumns({f"__{k}": F.coalesce(x, F.lit(0.0)) for k, x in (grown | plain).items()})
    # What the block before ended with.
    before = rows.window.rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumns({f"__e{k}": F.coalesce(F.last(F.when(F.col("__r") == block - 1, F.col(f"__{k}")), ignorenulls=True).over(before), F.lit(0.0)) for k in (*grown, *plain)})
    out = out.withColumns({f"__{k}": F.col(f"__{k}") * decay(F.col("__r")) + F.col(f"__e{k}") * decay(F.col("__r") + block) for k in grown})
    back = {f"__{k}{n}": rows.lag(f"__{k}", n) for n in lags for k in (*grown, *plain, "block")}
    columns = {}
    for n in lags:
        ga, gm, gam, gmm = (F.col(f"__{k}") - F.col(f"__{k}{n}") * 2.0 ** (-n / half_life) for k in grown)
        sum_a, sum_m, known = (F.col(f"__{k}") - F.col(f"__{k}{n}") + F.when(F.col("__block") != F.col(f"__block{n}"), F.col(f"__e{k}")).otherwise(0.0) for k in plain)
        mean_a, mean_m, factors = sum_a / n, sum_m / n, (1 - 2.0 ** (-n / half_life)) / (1 - 2.0 ** (-1 / half_life))
        cov = gam - mean_a * gm - mean_m * ga + mean_a * mean_m * factors
        var = gmm - 2 * mean_m * gm + mean_m * mean_m * factors
        columns[f"beta_{n}D"] = F.when((known == n) & (F.col("__row") > n), F.try_divide(cov, var))
    return out.withColumns(back).select(*df.columns, *[x.alias(k) for k, x in columns.items()])


def list_days(df: DataFrame, listing: DataFrame) -> DataFrame:
    """LIST_DAYNUM: days since the listing, null before it; listing holds code and list_date."""
    days = F.datediff("date", "list_date")
    return df.join(listing.select("code", "list_date"), "code", "left").withColumn("LIST_DAYNUM", F.when(days >= 0, days)).drop("list_date")


def resume_days(df: DataFrame, rows: Rows, index: str = "day_idx", most: int = 30) -> DataFrame:
    """RESUME_DAYNUM: traded days since a suspension; 0 in a key's first run and after most days."""
    out = df.withColumn("__gap", F.coalesce((F.col(index) - F.lag(index).over(rows.window) > 1).cast("int"), F.lit(0))).withColumn("__run", F.sum("__gap").over(rows.so_far))
    inside = Window.partitionBy(*rows.key, "__run").orderBy(rows.order)
    n = F.row_number().over(inside)
    return out.withColumn("RESUME_DAYNUM", F.when((F.col("__run") > 0) & (n <= most), n).otherwise(0)).drop("__gap", "__run")


def period_change(df: DataFrame, period: str, value: str, name: str, back: int = 1) -> DataFrame:
    """The first value of a period over that of the period `back` before it, less 1, on every row of the period; df holds one series."""
    first = df.groupBy(period).agg(F.min_by(value, "date").alias("__v"))
    w = Window.orderBy(period)
    change = first.withColumn(name, F.try_divide(F.col("__v"), F.lag("__v", back).over(w)) - 1).drop("__v")
    return df.join(F.broadcast(change), period)


def fill(df: DataFrame, rows: Rows, columns: list[str]) -> DataFrame:
    """Each null takes the last value before it, and the key's mean where there is none."""
    mean = Window.partitionBy(*rows.key)
    return df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(rows.so_far), F.avg(c).over(mean)) for c in columns})


def limits(df: DataFrame, rows: Rows, at: float = 0.095, flat: float = 0.001) -> DataFrame:
    """LIMIT_UP and LIMIT_DOWN at the open, and OPEN_AT_HIGH."""
    move = F.try_divide(F.col("open"), rows.lag("close")) - 1
    return df.withColumns({
        "LIMIT_UP": F.coalesce(move > at, F.lit(False)).cast("int"), "LIMIT_DOWN": F.coalesce(move < -at, F.lit(False)).cast("int"),
        "OPEN_AT_HIGH": F.coalesce(F.abs(F.try_divide(F.col("high"), F.col("open")) - 1) < flat, F.lit(False)).cast("int"),
    })
