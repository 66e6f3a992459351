"""Queries D1-D31: window features of the derived panels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.operators.bundles import AVERAGES, BANDS, BAR, BUNDLES, L7, Bundle, ValueSet, bundle_features, value_set
from quantloom.operators.cross_section import weighted_index
from quantloom.operators.carried import Carried, load_on, loaded
from quantloom.operators.recursive import recursive_features
from quantloom.operators.rolling import Rows, balance_volume, betas, fill, limits, list_days, period_change, resume_days, stochastics, volatility_ratio
from quantloom.operators.sliding import price_volume
from quantloom.plans.registry import ORACLE, query
from quantloom.sources import panels
from quantloom.sources.io import scratch
from quantloom.sources.panels import oracle

R = Rows()
NUMBERED = "n AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY date) AS rn FROM quotes)"


def out(df: DataFrame, columns: dict, digits: int = 6) -> DataFrame:
    return df.select("date", "code", *[F.round(c, digits).alias(k) for k, c in columns.items()])


def w(n: int) -> str:
    return f"(PARTITION BY code ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(aggregate: str, v: str, n: int) -> str:
    return f"CASE WHEN count({v}) OVER {w(n)} = {n} THEN {aggregate} OVER {w(n)} END"


def rows_sql(columns: dict[str, str], digits: int = 6, frm: str = "quotes", before: str = "") -> str:
    return oracle(f"{before} SELECT date, code, " + ", ".join(f"round({c}, {digits}) AS {k}" for k, c in columns.items()) + f" FROM {frm}".rstrip(), "quotes")


LAGS = (2, 5, 10, 20, 30, 60, 120, 250)


@query(rows_sql({f"MA_{n}D": full("avg(close)", "close", n) for n in LAGS}, 4))
def d1_moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"MA_{n}D": R.sma("close", n) for n in LAGS}, 4)


EMA_LIST = "WITH l AS (SELECT date, code, list(close) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) AS x FROM quotes)"


def ema_sql(x: str, n: int, first: str | None = None) -> str:
    """EMA of the last of list x: seeded by the mean of the n values that end at position first."""
    first = first or str(n)
    return f"CASE WHEN len({x}) >= {first} THEN list_reduce(list_prepend(list_avg({x}[{first} - {n - 1} : {first}]), {x}[{first} + 1 :]), lambda a, v: a + (v - a) * {2 / (n + 1)!r}) END"


@query(oracle(EMA_LIST + " SELECT date, code, " + ", ".join(f"round({ema_sql('x', n)}, 2) AS EMA_{n}D" for n in (5, 20)) + " FROM l", "quotes"))
def d2_exponential_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = recursive_features(panels.quotes(spark, sf_dir), ema_lags=(5, 20))
    return out(df, {f"EMA_{n}D": F.col(f"EMA_{n}D") for n in (5, 20)}, 2)


WMA_SQL = {f"WMA_{n}D": f"CASE WHEN count(close) OVER {w(n)} = {n} THEN (sum(close * rn) OVER {w(n)} - (rn - {n}) * sum(close) OVER {w(n)}) / ({n} * ({n} + 1) / 2) END" for n in (2, 5, 20)}


@query(oracle(f"WITH {NUMBERED} SELECT a.date, a.code, " + ", ".join(f"round(CASE WHEN a.rn >= {n} THEN sum(b.close * (b.rn - a.rn + {n})) FILTER (b.rn > a.rn - {n}) / ({n * (n + 1) / 2}) END, 3) AS WMA_{n}D" for n in (2, 5, 20)) + " FROM n a JOIN n b ON a.code = b.code AND b.rn BETWEEN a.rn - 19 AND a.rn GROUP BY a.date, a.code, a.rn", "quotes"))
def d3_weighted_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir).withColumn("row_number", R.number())
    return out(q, {f"WMA_{n}D": R.wma("close", n) for n in (2, 5, 20)}, 3)


def _ma_diff(spark, sf_dir, n: int) -> DataFrame:
    return panels.quotes(spark, sf_dir).withColumn("diff", F.col("close") - R.sma("close", n)).withColumn("sign", R.sign("diff"))


DIFF = "WITH d AS (SELECT *, close - " + full("avg(close)", "close", 5) + " AS diff FROM quotes), s AS (SELECT *, CASE WHEN diff > 0 THEN 1 WHEN diff IS NOT NULL THEN 0 END AS sign FROM d)"


@query(oracle(DIFF + " SELECT date, code, round(diff, 3) AS MA_DIFF_5D, sign AS MA_DIFF_SIGN_5D FROM s", "quotes"))
def d4_average_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ma_diff(spark, sf_dir, 5).select("date", "code", F.round("diff", 3).alias("MA_DIFF_5D"), F.col("sign").alias("MA_DIFF_SIGN_5D"))


@query(oracle(DIFF + f" SELECT date, code, ({full('sum(sign)', 'sign', 5)})::BIGINT AS MA_DIFF_PLUS_COUNT_5D, (5 - {full('sum(sign)', 'sign', 5)})::BIGINT AS MA_DIFF_NEGATIVE_COUNT_5D FROM s", "quotes"))
def d5_sign_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _ma_diff(spark, sf_dir, 5).withColumn("plus", R.plus_count("sign", 5))
    return q.select("date", "code", F.col("plus").alias("MA_DIFF_PLUS_COUNT_5D"), (5 - F.col("plus")).alias("MA_DIFF_NEGATIVE_COUNT_5D"))


def _runs(value: int) -> str:
    return f"""SELECT date, code, sum(hit) OVER (PARTITION BY code, run ORDER BY date ROWS UNBOUNDED PRECEDING)::BIGINT AS n FROM (
      SELECT *, sum(1 - hit) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT date, code, (coalesce(sign = {value}, false) AND row_number() OVER (PARTITION BY code ORDER BY date) > 1)::INT AS hit FROM s))"""


@query(oracle(DIFF + f", p AS ({_runs(1)}), m AS ({_runs(0)}) SELECT date, code, p.n AS MA_DIFF_CON_PLUS_COUNT_5D, m.n AS MA_DIFF_CON_NEGATIVE_COUNT_5D FROM p JOIN m USING (date, code)", "quotes"))
def d6_sign_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = R.run_lengths(_ma_diff(spark, sf_dir, 5), "sign", 1, "MA_DIFF_CON_PLUS_COUNT_5D")
    return R.run_lengths(q, "sign", 0, "MA_DIFF_CON_NEGATIVE_COUNT_5D").select("date", "code", "MA_DIFF_CON_PLUS_COUNT_5D", "MA_DIFF_CON_NEGATIVE_COUNT_5D")


@query(rows_sql({f"RET_{n}D": f"close / nullif(lag(close, {n}) OVER (PARTITION BY code ORDER BY date), 0) - 1" for n in LAGS}))
def d7_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"RET_{n}D": R.ret("close", n) for n in LAGS})


@query(rows_sql({f"STD_{n}D": full("stddev_samp(close)", "close", n) for n in (5, 20)}, 2))
def d8_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"STD_{n}D": R.std("close", n) for n in (5, 20)}, 2)


@query(rows_sql({f"BBANDS_{k}_{n}D": f"{full('avg(close)', 'close', n)} {s} 2 * {full('stddev_pop(close)', 'close', n)}" for n in (7, 21) for k, s in (("UPPER", "+"), ("LOWER", "-"))}, 2))
def d9_bollinger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"BBANDS_{k}_{n}D": R.bbands("close", n)[i] for n in (7, 21) for i, k in enumerate(("UPPER", "LOWER"))}, 2)


def macd_sql(value: str = "close", p: str = "", digits: int = 2, shift: float = 0.0) -> str:
    """MACD of every band; shift moves values off the ties of rounding."""
    shown = lambda x, name: f"round({x} + {shift}, {digits}) AS {p}MACD_{name}"
    bands = ", ".join(f"{shown(f'dea{n}', f'DEA_12_26_{n}D')}, {shown(f'2 * (raw - dea{n})', f'12_26_{n}D')}" for n in BANDS)
    return EMA_LIST.replace("list(close)", f"list({value})") + f""", d AS (SELECT date, code, {ema_sql('x', 12, '26')} - {ema_sql('x', 26)} AS dif FROM l WHERE len(x) >= 26),
  e AS (SELECT date, code, dif, list(dif) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) AS y FROM d),
  f AS (SELECT date, code, dif AS raw, CASE WHEN len(y) >= 7 THEN dif END AS dif, {", ".join(f"{ema_sql('y', n)} AS dea{n}" for n in BANDS)} FROM e)
  SELECT date, code, {shown('dif', 'DIF_12_26D')}, {bands} FROM quotes LEFT JOIN f USING (date, code)"""


@query(oracle(macd_sql(), "quotes"))
def d10_macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["MACD_DIF_12_26D", *(f"MACD_{x}12_26_{n}D" for n in BANDS for x in ("DEA_", ""))]
    return out(recursive_features(panels.quotes(spark, sf_dir), macd_lags=BANDS), {c: F.col(c) for c in names}, 2)


CLV = "coalesce((2 * close - high - low) / nullif(high - low, 0), 0)"


AD_SQL = f"WITH {NUMBERED} SELECT date, code, " + ", ".join(f"round(CASE WHEN rn > {n} THEN sum({CLV} * volume) OVER {w(n)} END, 6) AS AD_DIFF_{n}D" for n in BANDS) + " FROM n"


@query(oracle(AD_SQL, "quotes"))
def d11_accumulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"AD_DIFF_{n}D": R.ad_diff(n) for n in (7, 14, 21, 28)})


def _adx_sql(n: int) -> str:
    """CTEs of one lag: smoothed sums of range and moves from row n + 1 on, the index of their difference, and its own smoothing from row 2 n on."""
    sums = ", ".join(f"sum({x}) OVER (PARTITION BY code ORDER BY rn ROWS BETWEEN {n - 1} PRECEDING AND 1 PRECEDING) AS s_{x}" for x in ("tr", "up", "dn"))
    step = ", ".join(f"CASE WHEN w.rn = {n + 1} THEN s_{x} - s_{x} / {n} + w.{x} ELSE r.{x} - r.{x} / {n} + w.{x} END AS {x}" for x in ("tr", "up", "dn"))
    p, m = "CASE WHEN tr = 0 THEN 0 ELSE up / tr END", "CASE WHEN tr = 0 THEN 0 ELSE dn / tr END"
    return f"""w{n} AS (SELECT *, {sums} FROM m),
  r{n} AS (SELECT code, {n}::BIGINT AS rn, 0::DOUBLE AS tr, 0::DOUBLE AS up, 0::DOUBLE AS dn FROM w{n} WHERE rn = {n + 1} UNION ALL SELECT w.code, w.rn, {step} FROM r{n} r JOIN w{n} w ON w.code = r.code AND w.rn = r.rn + 1),
  x{n} AS (SELECT code, rn, CASE WHEN {p} + {m} = 0 THEN 0 ELSE 100 * abs({p} - {m}) / ({p} + {m}) END AS dx FROM r{n} WHERE rn > {n}),
  y{n} AS (SELECT *, avg(dx) OVER (PARTITION BY code ORDER BY rn ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS first FROM x{n}),
  a{n} AS (SELECT code, rn, first AS adx FROM y{n} WHERE rn = {2 * n} UNION ALL SELECT y.code, y.rn, a.adx + (y.dx - a.adx) / {n} FROM a{n} a JOIN y{n} y ON y.code = a.code AND y.rn = a.rn + 1)"""


def adx_sql(lags: tuple[int, ...]) -> str:
    return f"""WITH RECURSIVE b AS (SELECT date, code, high, low, row_number() OVER o AS rn, high - lag(high) OVER o AS u, lag(low) OVER o - low AS d, coalesce(lag(close) OVER o, close) AS pc FROM quotes WINDOW o AS (PARTITION BY code ORDER BY date)),
  m AS (SELECT date, code, rn, (greatest(high, pc) - least(low, pc))::DOUBLE AS tr, CASE WHEN u > d AND u > 0 THEN u ELSE 0 END::DOUBLE AS up, CASE WHEN d > u AND d > 0 THEN d ELSE 0 END::DOUBLE AS dn FROM b), {", ".join(map(_adx_sql, lags))}
  SELECT date, m.code, {", ".join(f"round(a{n}.adx, 6) AS ADX_{n}D" for n in lags)} FROM m {" ".join(f"LEFT JOIN a{n} ON a{n}.code = m.code AND a{n}.rn = m.rn" for n in lags)}"""


@query(oracle(adx_sql(BANDS), "quotes"))
def d12_adx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(recursive_features(panels.quotes(spark, sf_dir), adx_lags=BANDS), {f"ADX_{n}D": F.col(f"ADX_{n}D") for n in BANDS})


def _each(sql: Callable[[int], str], lags: tuple[int, ...] = BANDS, between: str = ", ") -> str:
    """The SQL of every lag."""
    return between.join(map(sql, lags))


def _cci(n: int) -> str:
    return f"round(CASE WHEN len(x{n}) = {n} THEN coalesce((tp - list_avg(x{n})) / nullif(0.015 * list_avg(list_transform(x{n}, lambda v: abs(v - list_avg(x{n})))), 0), 0) END, 6) AS CCI_{n}D"


CCI_SQL = f"""WITH {NUMBERED}, t AS (SELECT *, (high + low + close) / 3 AS tp FROM n), l AS (SELECT *, {_each(lambda n: f"list(tp) OVER {w(n)} AS x{n}")} FROM t)
  SELECT date, code, {_each(_cci)} FROM l"""


@query(oracle(CCI_SQL, "quotes"))
def d13_commodity_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"CCI_{n}D": R.cci(n) for n in BANDS})


def _wilder(x: str, n: int) -> str:
    return f"list_reduce(list_prepend(list_avg({x}[2 : {n + 1}]), {x}[{n + 2} :]), lambda a, v: (a * {n - 1} + v) / {n})"


RSI_SQL = f"""WITH c AS (SELECT date, code, coalesce(close - lag(close) OVER (PARTITION BY code ORDER BY date), 0) AS d FROM quotes),
  l AS (SELECT date, code, list(greatest(d, 0)) OVER u AS g, list(greatest(-d, 0)) OVER u AS b FROM c WINDOW u AS (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING)),
  s AS (SELECT date, code, {_each(lambda n: f"CASE WHEN len(g) > {n} THEN {_wilder('g', n)} END AS u{n}, CASE WHEN len(b) > {n} THEN {_wilder('b', n)} END AS v{n}")} FROM l)
  SELECT date, code, {_each(lambda n: f"round(CASE WHEN u{n} + v{n} = 0 THEN 0 ELSE 100 * u{n} / (u{n} + v{n}) END, 6) AS RSI_{n}D")} FROM s"""


@query(oracle(RSI_SQL, "quotes"))
def d14_relative_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(recursive_features(panels.quotes(spark, sf_dir), rsi_lags=BANDS), {f"RSI_{n}D": F.col(f"RSI_{n}D") for n in BANDS})


def _fast(n: int) -> str:
    return f"CASE WHEN rn >= {n} THEN coalesce(100 * (close - min(low) OVER {w(n)}) / nullif(max(high) OVER {w(n)} - min(low) OVER {w(n)}, 0), 0) END AS k{n}"


STOCH_SQL = f"""WITH {NUMBERED}, f AS (SELECT *, {_each(_fast)} FROM n),
  s AS (SELECT *, {_each(lambda n: f"{full(f'avg(k{n})', f'k{n}', 3)} AS sk{n}")} FROM f), t AS (SELECT *, {_each(lambda n: f"{full(f'avg(sk{n})', f'sk{n}', 3)} AS sd{n}")} FROM s)
  SELECT date, code, {_each(lambda n: f"round(CASE WHEN sd{n} IS NOT NULL THEN sk{n} END, 6) AS STOCH_K_{n}D, round(sd{n}, 6) AS STOCH_D_{n}D")} FROM t"""


@query(oracle(STOCH_SQL, "quotes"))
def d15_stochastics(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    for n in BANDS:
        q = stochastics(q, R, n)
    return out(q, {f"STOCH_{x}_{n}D": F.col(f"STOCH_{x}_{n}D") for n in BANDS for x in "KD"})


WILLER_SQL = f"WITH {NUMBERED} SELECT date, code, " + ", ".join(f"round(CASE WHEN rn >= {n} THEN coalesce(-100 * (max(high) OVER {w(n)} - close) / nullif(max(high) OVER {w(n)} - min(low) OVER {w(n)}, 0), 0) END, 6) AS WILLER_{n}D" for n in BANDS) + " FROM n"


@query(oracle(WILLER_SQL, "quotes"))
def d16_williams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"WILLER_{n}D": R.willr(n) for n in BANDS})


VR_SQL = f"""WITH p AS (SELECT *, lag(close) OVER (PARTITION BY code ORDER BY date) AS pc FROM quotes), t AS (SELECT *, greatest(high, pc) AS h, least(low, pc) AS l FROM p)
  SELECT date, code, {_each(lambda n: f"round((h - l) / nullif(max(h) OVER {w(n)} - min(l) OVER {w(n)}, 0), 6) AS VR_{n}D")} FROM t"""


@query(oracle(VR_SQL, "quotes"))
def d17_volatility_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    for n in BANDS:
        q = volatility_ratio(q, R, n)
    return out(q, {f"VR_{n}D": F.col(f"VR_{n}D") for n in BANDS})


@query(rows_sql({f"TURNOVER_ROLLING_SUM_{n}D": full("sum(turnover)", "turnover", n) for n in LAGS}))
def d18_turnover_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"TURNOVER_ROLLING_SUM_{n}D": R.rolling_sum("turnover", n) for n in LAGS})


@query(rows_sql({f"AMPLITUDE_{n}D": f"({full('max(high)', 'high', n)} - {full('min(low)', 'low', n)}) / nullif(lag(close, {n}) OVER (PARTITION BY code ORDER BY date), 0)" for n in L7}))
def d19_amplitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(panels.quotes(spark, sf_dir), {f"AMPLITUDE_{n}D": R.amplitude(n) for n in L7})


def _obv(v: str, name: str) -> str:
    return ", ".join(f"round(CASE WHEN rn > {n} THEN sum(s * {v}) OVER {w(n)} END, 2) AS {name}_{n}D" for n in (5, 20))


OBV = f"WITH {NUMBERED}, p AS (SELECT *, sign(close - lag(close) OVER (PARTITION BY code ORDER BY date)) AS s FROM n)"


@query(oracle(f"{OBV} SELECT date, code, {_obv('volume', 'OBV_DIFF')}, round(volume / {full('avg(volume)', 'volume', 5)}, 6) AS VOLUME_RATIO, round({full('avg(volume)', 'volume', 5)}, 4) AS VMA_5D, round(volume / nullif(lag(volume, 5) OVER (PARTITION BY code ORDER BY date), 0) - 1, 6) AS VRET_5D FROM p", "quotes"))
def d20_volume_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = balance_volume(panels.quotes(spark, sf_dir), R, "volume", (5, 20), "OBV_DIFF")
    return q.select("date", "code", *[F.round(f"OBV_DIFF_{n}D", 2).alias(f"OBV_DIFF_{n}D") for n in (5, 20)], F.round(R.to_mean("volume", 5), 6).alias("VOLUME_RATIO"), F.round(R.sma("volume", 5), 4).alias("VMA_5D"), F.round(R.ret("volume", 5), 6).alias("VRET_5D"))


@query(oracle(f"{OBV} SELECT date, code, {_obv('amount', 'AMT_OBV_DIFF')}, round(amount / {full('avg(amount)', 'amount', 5)}, 6) AS AMOUNT_RATIO_5D, round({full('avg(amount)', 'amount', 5)}, 2) AS AMTMA_5D FROM p", "quotes"))
def d21_amount_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = balance_volume(panels.quotes(spark, sf_dir), R, "amount", (5, 20), "AMT_OBV_DIFF")
    return q.select("date", "code", *[F.round(f"AMT_OBV_DIFF_{n}D", 2).alias(f"AMT_OBV_DIFF_{n}D") for n in (5, 20)], F.round(R.to_mean("amount", 5), 6).alias("AMOUNT_RATIO_5D"), F.round(R.sma("amount", 5), 2).alias("AMTMA_5D"))


@query(oracle("SELECT date, code, " + ", ".join(f"round({v} / {full(f'avg({v})', v, n)}, 6) AS {k}_TO_MA_{n}D" for v, k in (("close", "PRICE"), ("FREE_MRK_CAP", "FREE_MRK_CAP")) for n in (5, 20)) + " FROM quotes JOIN valuation USING (date, code)", "quotes", "valuation"))
def d22_to_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir).select("date", "code", "close").join(panels.valuation(spark, sf_dir).select("date", "code", "FREE_MRK_CAP"), ["date", "code"])
    return out(q, {f"{k}_TO_MA_{n}D": R.to_mean(v, n) for v, k in (("close", "PRICE"), ("FREE_MRK_CAP", "FREE_MRK_CAP")) for n in (5, 20)})


BETA_LAGS = (5, 10, 20, 60, 90, 120, 252)


@query(oracle("""WITH i AS (SELECT date, sum(close * volume) / sum(volume) AS px FROM quotes GROUP BY date), ir AS (SELECT date, px / lag(px) OVER (ORDER BY date) - 1 AS rm FROM i),
  a AS (SELECT q.date, code, close / lag(close) OVER (PARTITION BY code ORDER BY q.date) - 1 AS ra FROM quotes q),
  j AS (SELECT date, code, ra, rm, row_number() OVER (PARTITION BY code ORDER BY date) AS rn FROM a JOIN ir USING (date) WHERE ra IS NOT NULL AND rm IS NOT NULL) """
  + " SELECT x.date, x.code, " + ", ".join(f"round(beta{n}, 6) AS beta_{n}D" for n in BETA_LAGS) + " FROM j x "
  + " ".join(f"""LEFT JOIN (SELECT code, t, sum(w * (ra - ma) * (rm - mm)) / sum(w * (rm - mm) * (rm - mm)) AS beta{n} FROM (
    SELECT p.code, p.rn AS t, z.ra, z.rm, pow(0.5, (p.rn - z.rn) / 63.0) AS w, avg(z.ra) OVER g AS ma, avg(z.rm) OVER g AS mm FROM j p JOIN j z ON p.code = z.code AND z.rn BETWEEN p.rn - {n - 1} AND p.rn WHERE p.rn > {n}
    WINDOW g AS (PARTITION BY p.code, p.rn)) GROUP BY code, t) b{n} ON b{n}.code = x.code AND b{n}.t = x.rn""" for n in BETA_LAGS), "quotes"))
def d24_beta(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    index = q.groupBy("date").agg((F.sum(F.col("close") * F.col("volume")) / F.sum("volume")).alias("px"))
    series = Rows(key=("one",))
    market = index.withColumn("one", F.lit(1)).select("date", series.ret("px", 1).alias("rm"))
    joined = q.select("date", "code", R.ret("close", 1).alias("ra")).join(F.broadcast(market), "date").where("ra IS NOT NULL AND rm IS NOT NULL")
    return out(betas(joined, R, "ra", "rm", BETA_LAGS), {f"beta_{n}D": F.col(f"beta_{n}D") for n in BETA_LAGS})


PV_LAGS = (5, 10, 20, 30, 60, 90, 120)
RATIOS = "WITH r AS (SELECT *, " + _each(lambda n: f"amount / nullif({full('median(amount)', 'amount', n + 1)}, 0) AS r{n}", PV_LAGS) + " FROM quotes)"


def _pv(n: int) -> str:
    return f"(close / nullif(lag(close, {n}) OVER (PARTITION BY code ORDER BY date), 0) - 1) * {full(f'product(r{n})', f'r{n}', n)} AS PV_{n}D"


@query(oracle(f"{RATIOS}, v AS (SELECT date, code, {_each(_pv, PV_LAGS)} FROM r) SELECT date, code, {_each(lambda n: f'round(sign(PV_{n}D) * ln(1 + abs(PV_{n}D)), 6) AS PV_{n}D', PV_LAGS)} FROM v", "quotes"))
def d25_price_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products over many rows span many powers of ten, so they are compared as logarithms that keep the sign."""
    q = price_volume(panels.quotes(spark, sf_dir), R, PV_LAGS)
    return out(q, {f"PV_{n}D": F.signum(f"PV_{n}D") * F.ln(1 + F.abs(f"PV_{n}D")) for n in PV_LAGS})


@query(oracle(f"{RATIOS} SELECT date, code, {_each(lambda n: f'round((close / nullif(lag(close) OVER (PARTITION BY code ORDER BY date), 0) - 1) / nullif(r{n}, 0) * 100, 6) AS Market_Insight_{n}D', PV_LAGS)} FROM r", "quotes"))
def d26_market_insight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(price_volume(panels.quotes(spark, sf_dir), R, PV_LAGS), {f"Market_Insight_{n}D": F.col(f"Market_Insight_{n}D") for n in PV_LAGS})


@query(oracle("SELECT date, code, CASE WHEN date >= list_date THEN date - list_date END AS LIST_DAYNUM FROM quotes JOIN description USING (code)", "quotes", "description"))
def d27_days_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_days(panels.quotes(spark, sf_dir), panels.description(spark, sf_dir)).select("date", "code", F.col("LIST_DAYNUM").cast("long"))


@query(oracle("""WITH g AS (SELECT *, coalesce((day_idx - lag(day_idx) OVER (PARTITION BY code ORDER BY date) > 1)::INT, 0) AS gap FROM quotes),
  r AS (SELECT *, sum(gap) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM g), n AS (SELECT *, row_number() OVER (PARTITION BY code, run ORDER BY date) AS n FROM r)
  SELECT date, code, CASE WHEN run > 0 AND n <= 30 THEN n ELSE 0 END AS RESUME_DAYNUM FROM n""", "quotes"))
def d28_days_since_resumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume_days(panels.quotes(spark, sf_dir), R).select("date", "code", F.col("RESUME_DAYNUM").cast("long"))


@query(oracle("""WITH t AS (SELECT date, sum(value) AS value, year(date) * 100 + month(date) AS period FROM vals GROUP BY date), f AS (SELECT period, arg_min(value, date) AS v FROM t GROUP BY period),
  c AS (SELECT period, v / lag(v) OVER (ORDER BY period) - 1 AS mom, v / lag(v, 12) OVER (ORDER BY period) - 1 AS yoy FROM f) SELECT date, round(mom, 6) AS m0_mom, round(yoy, 6) AS m0_yoy FROM t JOIN c USING (period)""", "vals"))
def d29_period_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = panels.values(spark, sf_dir).groupBy("date").agg(F.sum("value").alias("value")).withColumn("period", (F.year("date") * 100 + F.month("date")))
    both = period_change(period_change(daily, "period", "value", "m0_mom"), "period", "value", "m0_yoy", 12)
    return both.select("date", F.round("m0_mom", 6).alias("m0_mom"), F.round("m0_yoy", 6).alias("m0_yoy"))


@query(oracle("""WITH h AS (SELECT date, code, CASE WHEN day_idx % 5 <> 0 THEN close END AS v FROM quotes)
  SELECT date, code, round(coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING), avg(v) OVER (PARTITION BY code)), 3) AS filled FROM h""", "quotes"))
def d30_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = panels.quotes(spark, sf_dir).select("date", "code", F.when(F.col("day_idx") % 5 != 0, F.col("close")).alias("filled"))
    return out(fill(holes, R, ["filled"]), {"filled": F.col("filled")}, 3)


@query(oracle("""WITH p AS (SELECT *, open / lag(close) OVER (PARTITION BY code ORDER BY date) - 1 AS m FROM quotes)
  SELECT date, code, coalesce(m > 0.095, false)::INT AS LIMIT_UP, coalesce(m < -0.095, false)::INT AS LIMIT_DOWN, coalesce(abs(high / nullif(open, 0) - 1) < 0.001, false)::INT AS OPEN_AT_HIGH FROM p""", "quotes"))
def d31_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits(panels.quotes(spark, sf_dir), R).select("date", "code", "LIMIT_UP", "LIMIT_DOWN", "OPEN_AT_HIGH")


def ema_steps(value: str, lags: tuple[int, ...]) -> str:
    """Recursive CTEs: n (rows numbered by code) and e, the EMA of each lag row by row, seeded by the mean of its first rows."""
    seeds = ", ".join(f"avg({value}) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS s{k}" for k in lags)
    steps = ", ".join(f"CASE WHEN n.rn < {k} THEN NULL WHEN n.rn = {k} THEN n.s{k} ELSE e.e{k} + (n.v - e.e{k}) * {2 / (k + 1)!r}::DOUBLE END" for k in lags)
    return f"""RECURSIVE n AS (SELECT date, code, {value}::DOUBLE AS v, row_number() OVER (PARTITION BY code ORDER BY date) AS rn, {seeds} FROM quotes),
  e AS (SELECT code, rn, {", ".join(f"NULL::DOUBLE AS e{k}" for k in lags)} FROM n WHERE rn = 1 UNION ALL SELECT n.code, n.rn, {steps} FROM e JOIN n ON n.code = e.code AND n.rn = e.rn + 1)"""


def _averages(value: str, lags: tuple[int, ...]) -> str:
    """CTE a: the three averages of each lag."""
    of = [f"CASE WHEN n.rn >= {k} THEN avg(v) OVER {w(k)} END AS MA_{k}, e{k} AS EMA_{k}, CASE WHEN n.rn >= {k} THEN (sum(v * n.rn) OVER {w(k)} - (n.rn - {k}) * sum(v) OVER {w(k)}) / {k * (k + 1) / 2}::DOUBLE END AS WMA_{k}" for k in lags]
    return f"{ema_steps(value, lags)}, a AS (SELECT n.date, n.code, n.rn, v, {', '.join(of).replace('PARTITION BY code', 'PARTITION BY n.code').replace('ORDER BY date', 'ORDER BY n.date')} FROM n JOIN e ON e.code = n.code AND e.rn = n.rn)"


DIFF_LAGS = ValueSet().long_lags
#: Moves differences off the grid of millionths that they are rounded to, so that none lies on a tie of the three digits shown.
OFF = 0.0000137
_KINDS = [(m, k) for m in AVERAGES for k in DIFF_LAGS]


def diffs_sql(value: str) -> str:
    """CTEs up to s: the differences d_ from each average and their signs s_."""
    return f"""WITH {_averages(value, DIFF_LAGS)}, b AS (SELECT date, code, rn, {", ".join(f"round(v - {m}_{k}, 6) AS d_{m}_{k}" for m, k in _KINDS)} FROM a),
  s AS (SELECT *, {", ".join(f"CASE WHEN d_{m}_{k} > 0 THEN 1 WHEN d_{m}_{k} IS NOT NULL THEN 0 END AS s_{m}_{k}" for m, k in _KINDS)} FROM b)"""


def _difference_columns(p: str, digits: int, shift: float) -> str:
    return ", ".join(f"round(d_{m}_{k} + {shift}, {digits}) AS {p}{m}_DIFF_{k}D, s_{m}_{k} AS {p}{m}_DIFF_SIGN_{k}D" for m, k in _KINDS)


def _counts_sql(m: str, k: int, p: str = "") -> str:
    run = lambda value: f"rn - max(CASE WHEN coalesce(s_{m}_{k} <> {value}, true) OR rn = 1 THEN rn END) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING)"
    plus = full(f"sum(s_{m}_{k})", f"s_{m}_{k}", k)
    p += f"{m}_DIFF"
    return f"({plus})::BIGINT AS {p}_PLUS_COUNT_{k}D, ({k} - {plus})::BIGINT AS {p}_NEGATIVE_COUNT_{k}D, ({run(1)})::BIGINT AS {p}_CON_PLUS_COUNT_{k}D, ({run(0)})::BIGINT AS {p}_CON_NEGATIVE_COUNT_{k}D"


def _differences(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...]) -> DataFrame:
    names = tuple(f"{m}_DIFF{c}_{k}D" for m, k in _KINDS for c in kinds)
    return value_set(panels.quotes(spark, sf_dir), R, ValueSet(returns=False, spreads=False, macd=()), names)


@query(oracle(f"{diffs_sql('close')} SELECT date, code, {_difference_columns('', 3, OFF)} FROM s", "quotes"))
def d4_difference_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _differences(spark, sf_dir, ("", "_SIGN")).select("date", "code", *[c for m, k in _KINDS for c in (F.round(F.col(f"{m}_DIFF_{k}D") + OFF, 3).alias(f"{m}_DIFF_{k}D"), F.col(f"{m}_DIFF_SIGN_{k}D"))])


@query(oracle(f"{diffs_sql('close')} SELECT date, code, " + ", ".join(_counts_sql(m, k) for m, k in _KINDS) + " FROM s", "quotes"))
def d5_d6_sign_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("PLUS_COUNT", "NEGATIVE_COUNT", "CON_PLUS_COUNT", "CON_NEGATIVE_COUNT")
    return _differences(spark, sf_dir, tuple(f"_{c}" for c in names)).select("date", "code", *[F.col(f"{m}_DIFF_{c}_{k}D").cast("long").alias(f"{m}_DIFF_{c}_{k}D") for m, k in _KINDS for c in names])


def levels_sql(value: str, p: str, digits: int = 2, shift: float = 0.0) -> str:
    """Averages, returns, deviations and bands of a value."""
    shown = lambda x, name: f"round({x} + {shift}, {digits}) AS {p}{name}"
    columns = [shown(f"{m}_{k}", f"{m}_{k}D") for m, k in _KINDS] + [f"round(v / nullif(lag(v, {k}) OVER (PARTITION BY code ORDER BY date), 0) - 1, 6) AS {p}RET_{k}D" for k in L7]
    columns += [shown(full("stddev_samp(v)", "v", k), f"STD_{k}D") for k in DIFF_LAGS if k >= 5]
    columns += [shown(f"{full('avg(v)', 'v', k)} {s} 2 * {full('stddev_pop(v)', 'v', k)}", f"BBANDS_{side}_{k}D") for k in BANDS for side, s in (("UPPER", "+"), ("LOWER", "-"))]
    return f"WITH {_averages(value, DIFF_LAGS)} SELECT date, code, {', '.join(columns)} FROM a"


def together(*parts: str) -> str:
    """The columns of the parts side by side, by date and code."""
    return "SELECT * FROM " + " JOIN ".join(f"({part}) {'USING (date, code)' if i else ''}" for i, part in enumerate(parts))


def _value_set(spark: SparkSession, sf_dir: str, value: str, p: str) -> DataFrame:
    found = value_set(panels.quotes(spark, sf_dir).withColumn(value, F.col(value).cast("double")), R, ValueSet(value, p, differences=False), shown=lambda c: (6 if f"{p}RET" in c else 2, 0.0))
    return found.select("date", "code", *[c for c in found.columns if c not in ("date", "code")])


@query(oracle(together(levels_sql("volume", "V"), macd_sql("volume", "V")), "quotes"))
def d20_volume_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _value_set(spark, sf_dir, "volume", "V")


@query(oracle(together(levels_sql("amount", "AMT"), macd_sql("amount", "AMT")), "quotes"))
def d21_amount_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _value_set(spark, sf_dir, "amount", "AMT")


@query(oracle("WITH v AS (SELECT date, series_id AS code, CASE WHEN day_idx % 5 <> 0 THEN close END AS x FROM series), f AS (SELECT date, code, coalesce(last_value(x IGNORE NULLS) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING), avg(x) OVER (PARTITION BY code)) AS close FROM v) "
  + "SELECT date, code, " + ", ".join(f"round(close / nullif(lag(close, {k}) OVER (PARTITION BY code ORDER BY date), 0) - 1, 6) AS RET_{k}D" for k in L7) + " FROM f", "series"))
def d23_series_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns of single series with holes, which are filled first, by the mean where nothing is before."""
    holes = panels.series(spark, sf_dir).select("date", F.col("series_id").alias("code"), F.when(F.col("day_idx") % 5 != 0, F.col("close")).alias("close"))
    found = value_set(fill(holes, R, ["close"]), R, ValueSet(averages=False, spreads=False, macd=(), differences=False))
    return found.select("date", "code", *[F.round(f"RET_{k}D", 6).alias(f"RET_{k}D") for k in L7])


#: Digits and shift of what a bundle's query shows of a value's levels and of its differences.
SHOWN = {"close": ((2, 0.0), (3, OFF)), "volume": ((2, 0.0), (3, OFF)), "amount": ((0, 0.0137), (0, 0.0137))}


def bundle_sql(bundle: Bundle) -> str:
    """All columns of a bundle of the table quotes, from the SQL of its parts."""
    parts = []
    for s in bundle.sets:
        (digits, shift), (fine, off) = SHOWN[s.value]
        counts = ", ".join(_counts_sql(m, k, s.prefix) for m, k in _KINDS)
        parts += [levels_sql(s.value, s.prefix, digits, shift), macd_sql(s.value, s.prefix, digits, shift), f"{diffs_sql(s.value)} SELECT date, code, {_difference_columns(s.prefix, fine, off)}, {counts} FROM s"]
    if bundle.bars:
        parts += [AD_SQL, adx_sql(BANDS), CCI_SQL, RSI_SQL, STOCH_SQL, WILLER_SQL, VR_SQL]
    columns = {f"{name}_TO_MA_{n}D": f"{v} / nullif({full(f'avg({v})', v, n)}, 0)" for v, name in bundle.to_average for n in bundle.lags if n >= 2}
    columns |= {name.format(n): f"{v} / nullif({full(f'avg({v})', v, n)}, 0)" for v, name, lags in bundle.ratios for n in lags}
    columns |= {f"{name}_{n}D": f"CASE WHEN rn > {n} THEN sum(s * {v}) OVER {w(n)} END" for v, name in bundle.balances for n in bundle.lags}
    if bundle.sums:
        columns |= {f"TURNOVER_ROLLING_SUM_{n}D": full("sum(turnover)", "turnover", n) for n in bundle.lags}
        columns |= {f"AMPLITUDE_{n}D": f"({full('max(high)', 'high', n)} - {full('min(low)', 'low', n)}) / nullif(lag(close, {n}) OVER (PARTITION BY code ORDER BY date), 0)" for n in bundle.lags}
    if columns:
        parts.append(f"{OBV} SELECT date, code, {', '.join(f'round({c}, 6) AS {k}' for k, c in columns.items())} FROM p")
    return together(*parts)


def shown_bundle(df: DataFrame, bundle: Bundle) -> DataFrame:
    """date, code and the bundle's features, rounded; counts as whole numbers. df has its key as code."""
    kinds = ("MA_", "EMA_", "WMA_", "STD_", "BBANDS_", "MACD_")

    def shown(c: str) -> tuple[int, float] | None:
        if "_SIGN_" in c or "_COUNT_" in c:
            return None
        for s in bundle.sets:
            if c.startswith(tuple(s.prefix + k for k in kinds)):
                return SHOWN[s.value]["_DIFF_" in c and "MACD" not in c]
        return 6, 0.0

    found = bundle_features(df, R, bundle, shown=shown)
    return found.select("date", "code", *[F.col(c).cast("long").alias(c) if "_COUNT_" in c else F.col(c) for c in found.columns if c not in ("date", "code")])


#: Bars of series with every fifth row unknown but for its date.
_HOLES_SQL = ("WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) AS place FROM series), holes AS (SELECT date, series_id AS code, " + ", ".join(f"CASE WHEN place % 5 <> 3 THEN {c} END AS {c}" for c in BAR)
  + " FROM numbered), quotes AS (SELECT date, code, " + ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) AS {c}" for c in BAR) + " FROM holes) ")


def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = panels.series(spark, sf_dir).withColumnRenamed("series_id", "code").withColumn("place", R.number())
    return s.select("date", "code", *[F.when(F.col("place") % 5 != 3, F.col(c)).alias(c) for c in BAR])


@query(oracle(bundle_sql(BUNDLES["price"]), "quotes"))
def d23_price_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_bundle(panels.quotes(spark, sf_dir), BUNDLES["price"])


@query(oracle(bundle_sql(BUNDLES["stationary"]), "quotes"))
def d23_stationary_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_bundle(panels.quotes(spark, sf_dir), BUNDLES["stationary"])


@query(oracle(_HOLES_SQL + bundle_sql(BUNDLES["series"]), "series"))
def d23_series_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_bundle(_holes(spark, sf_dir), BUNDLES["series"])


@query(oracle("WITH quotes AS (SELECT date, series_id AS code, floor(value / 100000) AS close FROM vals) " + bundle_sql(BUNDLES["close_only"]), "vals"))
def d23_close_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = panels.values(spark, sf_dir).select("date", F.col("series_id").alias("code"), F.floor(F.col("value") / 100000).cast("double").alias("close"))
    return shown_bundle(v, BUNDLES["close_only"])


@query(oracle("WITH quotes AS (SELECT date, series_id AS code, value AS close FROM vals) " + bundle_sql(BUNDLES["ratio_only"]), "vals"))
def d23_ratio_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = panels.values(spark, sf_dir).select("date", F.col("series_id").alias("code"), F.col("value").alias("close"))
    return shown_bundle(v, BUNDLES["ratio_only"])


@query(oracle(_HOLES_SQL + bundle_sql(BUNDLES["series_stationary"]), "series"))
def d23_series_stationary_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_bundle(_holes(spark, sf_dir), BUNDLES["series_stationary"])


_INDUSTRY_SQL = ("WITH weighted AS (SELECT q.*, FREE_MRK_CAP AS w, industry FROM quotes q JOIN (SELECT date, code, FREE_MRK_CAP FROM valuation) USING (date, code) JOIN (SELECT code, industry FROM description) USING (code)), "
  + "means AS (SELECT date, industry AS code, " + ", ".join(f"floor(sum({c} * w) / sum(w) + 0.5) AS {c}" for c in BAR[:-1]) + " FROM weighted GROUP BY ALL), bars AS (SELECT *, volume / 1000 AS turnover FROM means) ")


def industry_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of industries: cap-weighted means in whole cents, the industry as code."""
    caps = panels.valuation(spark, sf_dir).select("date", "code", F.col("FREE_MRK_CAP").alias("w"))
    q = panels.quotes(spark, sf_dir).join(caps, ["date", "code"]).join(panels.description(spark, sf_dir).select("code", "industry"), "code")
    bars = weighted_index(q, ["date", "industry"], list(BAR[:-1]), "w")
    return bars.select("date", F.col("industry").alias("code"), *[F.floor(F.col(c) + 0.5).cast("double").alias(c) for c in BAR[:-1]]).withColumn("turnover", F.col("volume") / 1000)


@query(oracle(_INDUSTRY_SQL + bundle_sql(BUNDLES["price"]).replace("FROM quotes", "FROM bars"), "quotes", "valuation", "description"))
def d23_industry_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_bundle(industry_bars(spark, sf_dir), BUNDLES["price"])


CARRIED = Carried(ema_lags=(5, 20), macd_lags=BANDS, rsi_lags=BANDS, adx_lags=BANDS)
_TOGETHER = " JOIN ".join(f"({ORACLE[name]}) {'USING (date, code)' if i else ''}" for i, name in enumerate(("d2_exponential_average", "d10_macd", "d14_relative_strength", "d12_adx", "d28_days_since_resumption")))


@query(f"SELECT *, row_number() OVER (PARTITION BY code ORDER BY date) AS row_number FROM {_TOGETHER}")
def a9_carried_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, each from its own years of bars and the state that the one before left."""
    q, path = panels.quotes_by_year(spark, sf_dir), scratch(spark, "carried")
    for number, years in enumerate(("year <= 1993", "year BETWEEN 1994 AND 1996", "year >= 1997")):
        load_on(spark, q.where(years), path, number, CARRIED)
    digits = {c: 6 if c[:3] in ("RSI", "ADX") else 2 for c in CARRIED.names}
    return loaded(spark, path, CARRIED).select("date", "code", "row_number", *[F.round(c, d).alias(c) for c, d in digits.items()], "RESUME_DAYNUM")
