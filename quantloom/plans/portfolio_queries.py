"""Queries J1-J19, D23 and the daily plan: portfolios and composed jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.operators import cross_section as cs
from quantloom.operators import portfolio as pf
from quantloom.operators.bundles import AMOUNT, BUNDLES, PRICE, VOLUME, Bundle, bundle_features
from quantloom.operators.rolling import Rows, limits
from quantloom.plans.registry import query
from quantloom.plans.window_queries import full, w
from quantloom.sources import panels
from quantloom.sources.panels import oracle

R = Rows()
TODAY = "1998-06-30"
Y = "y AS (SELECT c.date, p.code, p.proba_1_5D FROM predictions p JOIN calendar c ON c.day_idx = p.day_idx + 1)"
CAND = f"""{Y}, l AS (SELECT date, code, coalesce(open / nullif(lag(close) OVER (PARTITION BY code ORDER BY date), 0) - 1 > 0.095, false) AS up FROM quotes),
  cand AS (SELECT y.date, code, proba_1_5D, day_idx FROM y JOIN l USING (date, code) JOIN flags USING (date, code) JOIN description USING (code) JOIN calendar USING (date) WHERE NOT up AND ST_FLAG = 0 AND y.date - list_date > 60)"""
NEED = ("quotes", "predictions", "flags", "description")


def _yesterday(spark, sf_dir) -> DataFrame:
    return pf.yesterdays(panels.predictions(spark, sf_dir), panels.calendar(spark, sf_dir), ["proba_1_5D"])


def _candidates(spark, sf_dir) -> DataFrame:
    q = limits(panels.quotes(spark, sf_dir), R)
    found = pf.candidates(_yesterday(spark, sf_dir), q, panels.flags(spark, sf_dir), panels.description(spark, sf_dir), score="proba_1_5D")
    return found.join(F.broadcast(panels.calendar(spark, sf_dir)), "date")


@query(oracle(f"WITH {Y} SELECT date, code, round(proba_1_5D, 9) AS proba_1_5D FROM y", "predictions", "calendar"))
def j1_yesterdays_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.rounded(_yesterday(spark, sf_dir), ["date", "code"], ["proba_1_5D"], 9)


@query(oracle(f"WITH {CAND} SELECT date, code, round(proba_1_5D, 9) AS proba_1_5D FROM cand", *NEED))
def j2_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.rounded(_candidates(spark, sf_dir), ["date", "code"], ["proba_1_5D"], 9)


@query(oracle(f"WITH {CAND}, r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY proba_1_5D DESC, code) AS rank FROM cand) SELECT date, code, rank FROM r WHERE rank <= 3", *NEED))
def j3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.top_k(_candidates(spark, sf_dir), "proba_1_5D", 3).select("date", "code", F.col("rank").cast("long").alias("rank"))


MATRIX = """s AS (SELECT f.code, c.date, c.day_idx FROM (SELECT code, min(date) AS first FROM quotes GROUP BY code) f JOIN calendar c ON c.date >= first),
  m AS (SELECT s.date, s.code, s.day_idx, q.code IS NOT NULL AS tradable, last_value(q.open IGNORE NULLS) OVER v AS open, last_value(q.high IGNORE NULLS) OVER v AS high FROM s LEFT JOIN quotes q ON q.date = s.date AND q.code = s.code
  WINDOW v AS (PARTITION BY s.code ORDER BY s.date ROWS UNBOUNDED PRECEDING))"""


def _matrix(spark, sf_dir) -> DataFrame:
    return pf.price_matrix(panels.quotes(spark, sf_dir), panels.calendar(spark, sf_dir), ["open", "high"])


@query(oracle(f"WITH {MATRIX} SELECT date, code, tradable, open, high FROM m", "quotes"))
def j4_price_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir).select("date", "code", "tradable", "open", "high")


LAYERS = """r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY proba_1_5D DESC, code) - 1 AS rk, count(*) OVER (PARTITION BY date) AS n FROM cand WHERE day_idx % 5 = 0),
  ly AS (SELECT date, code, day_idx, """ + " + ".join(f"(rk >= floor(n * {k} / 3.0))::INT" for k in (1, 2)) + """ AS layer FROM r), lw AS (SELECT *, 1.0 / count(*) OVER (PARTITION BY date, layer) AS weight FROM ly)"""


def _layers(spark, sf_dir) -> DataFrame:
    return pf.layers(_candidates(spark, sf_dir), "proba_1_5D", 3, 5)


@query(oracle(f"WITH {CAND}, {LAYERS} SELECT date, code, layer, round(weight, 9) AS weight FROM lw", *NEED))
def j5_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.rounded(_layers(spark, sf_dir), ["date", "code", "layer"], ["weight"], 9)


HELD = f"""WITH {CAND}, {LAYERS}, {MATRIX}, h AS (SELECT c.date, lw.code, layer, weight, c.day_idx = lw.day_idx AS bought FROM lw JOIN calendar c ON c.day_idx BETWEEN lw.day_idx AND lw.day_idx + 4),
  mv AS (SELECT date, code, lead(open) OVER (PARTITION BY code ORDER BY date) / nullif(open, 0) - 1 AS move FROM m),
  rt AS (SELECT layer, date, sum(coalesce(weight * move, 0) - CASE WHEN bought THEN 0.001 * weight ELSE 0 END)::DOUBLE AS ret FROM h LEFT JOIN mv USING (date, code) GROUP BY ALL)"""


def _moves(spark, sf_dir) -> DataFrame:
    return pf.moves_between(panels.quotes(spark, sf_dir), panels.calendar(spark, sf_dir))


def _returns(spark, sf_dir) -> DataFrame:
    held = pf.held_days(_layers(spark, sf_dir), panels.calendar(spark, sf_dir), 5)
    return pf.portfolio_returns(held, _moves(spark, sf_dir), ["layer"], commission=0.001)


@query(oracle(f"{HELD} SELECT layer, date, round(ret, 6) AS ret FROM rt", *NEED))
def j6_layer_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.rounded(_returns(spark, sf_dir), ["layer", "date"], ["ret"])


#: Baskets that wait: of every day, then those that are really bought, by walking from one to the next.
WAITING = f"""WITH RECURSIVE {CAND},
  rw AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY proba_1_5D DESC, code) - 1 AS rk, count(*) OVER (PARTITION BY date) AS n FROM cand),
  lw AS (SELECT date, code, day_idx, layer, 1.0 / count(*) OVER (PARTITION BY date, layer) AS weight FROM (SELECT *, """ + " + ".join(f"(rk >= floor(n * {k} / 3.0))::INT" for k in (1, 2)) + """ AS layer FROM rw)),
  sd AS (SELECT code, day_idx FROM (SELECT code, day_idx, coalesce(open / nullif(lag(close) OVER (PARTITION BY code ORDER BY date), 0) - 1 < -0.095, false) AS down FROM quotes) WHERE NOT down),
  due AS MATERIALIZED (SELECT lw.*, sd.day_idx AS sold_idx FROM lw ASOF LEFT JOIN sd ON lw.code = sd.code AND lw.day_idx + 5 <= sd.day_idx),
  fr AS MATERIALIZED (SELECT layer, day_idx, CASE WHEN count(sold_idx) = count(*) THEN max(sold_idx) END AS free FROM due GROUP BY ALL),
  nx AS MATERIALIZED (SELECT fr.layer, fr.day_idx, n.day_idx AS next FROM fr ASOF LEFT JOIN fr n ON fr.layer = n.layer AND fr.free <= n.day_idx),
  walk AS (SELECT layer, min(day_idx) AS day_idx FROM fr GROUP BY layer UNION ALL SELECT layer, next FROM walk JOIN nx USING (layer, day_idx) WHERE next IS NOT NULL),
  wb AS (SELECT due.* FROM due JOIN walk USING (layer, day_idx))"""


def _waiting(spark, sf_dir) -> DataFrame:
    q = limits(panels.quotes(spark, sf_dir), R)
    every_day = pf.layers(_candidates(spark, sf_dir), "proba_1_5D", 3, 1).select("date", "code", "day_idx", "layer", "weight")
    return pf.waiting_baskets(every_day, q.where("LIMIT_DOWN = 0").select("code", "day_idx"), 5)


@query(oracle(f"{WAITING} SELECT date, code, layer, round(weight, 9) AS weight, sold_idx FROM wb", *NEED))
def j5_waiting_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _waiting(spark, sf_dir).select("date", "code", "layer", F.round("weight", 9).alias("weight"), "sold_idx")


@query(oracle(f"""{WAITING}, {MATRIX}, e AS (SELECT max(day_idx) AS last FROM calendar),
  h AS (SELECT c.date, wb.code, layer, weight, c.day_idx = wb.day_idx AS bought FROM wb, e JOIN calendar c ON c.day_idx BETWEEN wb.day_idx AND coalesce(sold_idx - 1, last)),
  mv AS (SELECT date, code, lead(open) OVER (PARTITION BY code ORDER BY date) / nullif(open, 0) - 1 AS move FROM m)
  SELECT layer, date, round(sum(coalesce(weight * move, 0) - CASE WHEN bought THEN 0.001 * weight ELSE 0 END)::DOUBLE, 6) AS ret FROM h LEFT JOIN mv USING (date, code) GROUP BY ALL""", *NEED))
def j6_waiting_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = pf.held_until(_waiting(spark, sf_dir), panels.calendar(spark, sf_dir))
    return pf.rounded(pf.portfolio_returns(held, _moves(spark, sf_dir), ["layer"], commission=0.001), ["layer", "date"], ["ret"])


POS = """f AS (SELECT code, date, action, lag(action) OVER (PARTITION BY code ORDER BY date, action) AS p, day_idx + 1 AS fill_idx FROM trades), t AS (SELECT * FROM f WHERE (action = 0 AND (p IS NULL OR p = 1)) OR (action = 1 AND p = 0)),
  pos AS (SELECT * FROM (SELECT code, action, fill_idx AS start_idx, lead(fill_idx) OVER (PARTITION BY code ORDER BY date, action) AS end_idx FROM t) WHERE action = 0)"""


def _positions(spark, sf_dir) -> DataFrame:
    days = F.broadcast(panels.calendar(spark, sf_dir).select(F.col("date").alias("fill_date"), F.col("day_idx").alias("fill_idx")))
    filled = panels.orders(spark, sf_dir).withColumn("fill_idx", F.col("day_idx") + 1).join(days, "fill_idx", "left")
    return pf.replayed(filled, ["code"])


@query(oracle(f"WITH {POS} SELECT code, start_idx, end_idx FROM pos", "trades"))
def j7_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(spark, sf_dir).select("code", "start_idx", "end_idx")


@query(oracle(f"WITH {POS} SELECT date, round(count(*) / 5, 6) AS weight FROM pos JOIN calendar c ON c.day_idx >= start_idx AND (end_idx IS NULL OR c.day_idx < end_idx) GROUP BY date HAVING count(*) > 5", "trades", "calendar"))
def j7_over_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.over_weight(_positions(spark, sf_dir), panels.calendar(spark, sf_dir), [], 5)


@query(oracle(f"WITH {POS} SELECT code, round(avg(end_idx - start_idx), 6) AS holding_days FROM pos WHERE end_idx IS NOT NULL GROUP BY code", "trades"))
def j8_holding_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.rounded(pf.holding_days(_positions(spark, sf_dir), ["code"]), ["code"], ["holding_days"])


MEASURES = ["annual_return", "annual_std", "sharpe", "max_drawdown", "log_growth"]


def _measured(df: DataFrame, keys: list[str]) -> DataFrame:
    """The stand-in's prices jump, so growth is compared as a logarithm."""
    return pf.rounded(df.withColumn("log_growth", F.ln(1 + F.col("cumulative"))), keys, MEASURES, 5)


def _measures(keys: str, dev: str) -> str:
    return f"""pv AS (SELECT *, product(1 + ret) OVER u AS v FROM src WINDOW u AS (PARTITION BY {keys} ORDER BY date ROWS UNBOUNDED PRECEDING)), pk AS (SELECT *, max(v) OVER (PARTITION BY {keys} ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM pv)
  SELECT {keys}, round(avg(ret) * 252, 5) AS annual_return, round({dev}(ret) * sqrt(252), 5) AS annual_std, round(avg(ret) * 252 / nullif({dev}(ret) * sqrt(252), 0), 5) AS sharpe, round(min(v / peak - 1), 5) AS max_drawdown, round(ln(arg_max(v, date)), 5) AS log_growth FROM pk GROUP BY {keys}"""


@query(oracle("""WITH b AS (SELECT DISTINCT day_idx FROM quotes WHERE day_idx % 7 = 0), f AS (SELECT day_idx FROM calendar ANTI JOIN b USING (day_idx)), x AS (SELECT c.day_idx AS due_idx, (SELECT min(f.day_idx) FROM f WHERE f.day_idx >= c.day_idx) AS day_idx FROM calendar c WHERE c.day_idx % 5 = 0)
  SELECT min(due_idx) AS due_idx, day_idx FROM x WHERE day_idx IS NOT NULL GROUP BY day_idx""", "quotes"))
def j5_after_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = panels.quotes(spark, sf_dir).where("day_idx % 7 = 0").select("day_idx")
    return pf.after_closing(panels.calendar(spark, sf_dir).select(F.col("day_idx").cast("long").alias("day_idx")), blocked, 5)


@query(oracle(f"{HELD}, src AS (SELECT * FROM rt), {_measures('layer', 'stddev_samp')}", *NEED))
def j9_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(pf.performance(_returns(spark, sf_dir), ["layer"]), ["layer"])


@query(oracle(f"{HELD}, src AS (SELECT *, year(date) AS year FROM rt), {_measures('layer, year', 'stddev_pop')}", *NEED))
def j9_yearly_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(pf.performance(_returns(spark, sf_dir), ["layer"], yearly=True), ["layer", "year"])


@query(oracle(f"WITH src AS (SELECT series_id, date, coalesce(open / nullif(lag(open) OVER (PARTITION BY series_id ORDER BY date), 0) - 1, 0) AS ret FROM series ), {_measures('series_id', 'stddev_samp')}", "series"))
def j10_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Rows(key=("series_id",))
    s = panels.series(spark, sf_dir).select("series_id", "date", F.coalesce(rows.ret("open", 1), F.lit(0.0)).alias("ret"))
    return _measured(pf.performance(s, ["series_id"]), ["series_id"])


@query(oracle(f"""WITH d AS (SELECT max(date) AS d FROM predictions WHERE date <= DATE '{TODAY}'), s AS (SELECT code, proba_1_5D AS p, row_number() OVER (ORDER BY proba_1_5D DESC, code) AS r FROM predictions, d WHERE date = d), b AS (SELECT code FROM s WHERE r <= 5),
  h AS (SELECT code, key % 30 AS hp FROM description), x AS (SELECT h.code FROM h LEFT JOIN s USING (code) WHERE hp >= 20 OR p < 0.5)
  SELECT code, 'buy' AS side FROM b UNION ALL SELECT code, 'sell' FROM x WHERE code NOT IN (SELECT code FROM b)""", "predictions", "description"))
def j13_trade_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panels.predictions(spark, sf_dir).where(f"date <= DATE '{TODAY}'")
    today = p.join(F.broadcast(p.agg(F.max("date").alias("date"))), "date")
    held = panels.description(spark, sf_dir).select("code", (F.col("key") % 30).alias("holding_period"))
    return pf.trade_list(today.select("code", "proba_1_5D"), held, "proba_1_5D", buys=5)


@query(oracle("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY date DESC) AS n FROM predictions)
  SELECT code, string_agg(date::VARCHAR || '=' || (proba_1_5D * 10007)::BIGINT, ',' ORDER BY date) AS history FROM r WHERE n <= 10 GROUP BY code""", "predictions"))
def j14_score_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pf.score_history(panels.predictions(spark, sf_dir), ["proba_1_5D"])
    return found.select("code", F.array_join(F.transform("history", lambda h: F.concat(h["date"].cast("string"), F.lit("="), F.round(h["proba_1_5D"] * 10007).cast("bigint").cast("string"))), ",").alias("history"))


@query(oracle("WITH o AS (SELECT date, code, open AS price, floor(2000000000 / 20 / (open * 1.001::DOUBLE) / 100) * 100 AS volume FROM quotes) SELECT date, code, volume::BIGINT AS volume, round(volume * price, 2) AS cost, round(volume * price * 0.001, 2) AS commission FROM o", "quotes"))
def j15_sized_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    buys = panels.quotes(spark, sf_dir).select("date", "code", F.col("open").alias("price"))
    return pf.rounded(pf.sized_orders(buys, 2e9, 20), ["date", "code", F.col("volume").cast("long").alias("volume")], ["cost", "commission"], 2)


@query(oracle(f"""WITH p AS (SELECT code, key % 4 AS account, arg_min(open, date) AS open_price, 100 * (1 + key % 5) AS volume FROM quotes GROUP BY code, key), s AS (SELECT code, max(date) AS end_date, arg_max(close, date) AS close_price FROM quotes GROUP BY code),
  j AS (SELECT code, account, end_date, volume * close_price AS revenue, volume * close_price * 0.001::DOUBLE AS commission, volume * open_price AS cost FROM p JOIN s USING (code))
  SELECT code, account, end_date, revenue, round(commission, 3) AS commission, round(revenue - commission - cost, 3) AS PnL, round(1000000 + sum(revenue - commission) OVER (PARTITION BY account ORDER BY end_date, code ROWS UNBOUNDED PRECEDING), 1) AS balance FROM j""", "quotes"))
def j16_closed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    held = q.groupBy("code", "key").agg(F.min_by("open", "date").alias("open_price")).select("code", (F.col("key") % 4).alias("account"), (100 * (1 + F.col("key") % 5)).alias("volume"), (100 * (1 + F.col("key") % 5) * F.col("open_price")).alias("cost"))
    sells = q.groupBy("code").agg(F.max("date").alias("end_date"), F.max_by("close", "date").alias("close_price"))
    found = pf.closed_records(sells, held, 1e6)
    return found.select("code", "account", "end_date", "revenue", F.round("commission", 3).alias("commission"), F.round("PnL", 3).alias("PnL"), F.round("balance", 1).alias("balance"))


@query(oracle(f"""WITH p AS (SELECT code, min(date) AS start_date, arg_min(open, date) AS open_price, 100 AS volume FROM quotes WHERE date >= DATE '1998-01-01' GROUP BY code),
  h AS (SELECT p.*, count(*) AS holding_period FROM p JOIN calendar c ON c.date >= start_date AND c.date <= DATE '{TODAY}' GROUP BY ALL)
  SELECT h.code, holding_period, (q.close - open_price) * h.volume AS floating_PnL FROM h LEFT JOIN quotes q ON q.code = h.code AND q.date = DATE '{TODAY}'""", "quotes"))
def j17_marked_to_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    held = q.where("date >= DATE '1998-01-01'").groupBy("code").agg(F.min("date").alias("start_date"), F.min_by("open", "date").alias("open_price")).withColumn("volume", F.lit(100))
    return pf.marked_to_market(held, q, panels.calendar(spark, sf_dir), TODAY).select("code", "holding_period", "floating_PnL")


@query(oracle("""WITH v AS (SELECT series_id, date, close, close / lag(close) OVER u - 1 AS dr, row_number() OVER u - 1 AS duration, close / max(close) OVER s - 1 AS gap, close / first(close) OVER s AS total FROM series
    WINDOW u AS (PARTITION BY series_id ORDER BY date), s AS (PARTITION BY series_id ORDER BY date ROWS UNBOUNDED PRECEDING))
  SELECT series_id, date, round(dr, 6) AS daily_return, round(stddev_samp(dr) OVER s * sqrt(252), 6) AS annualized_std, round(min(gap) OVER s, 6) AS max_drawdown, duration FROM v WINDOW s AS (PARTITION BY series_id ORDER BY date ROWS UNBOUNDED PRECEDING)""", "series"))
def j18_performance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pf.performance_rows(panels.series(spark, sf_dir).select("series_id", "date", F.col("close").alias("market_value")), ["series_id"])
    return found.select("series_id", "date", *[F.round(c, 6).alias(c) for c in ("daily_return", "annualized_std", "max_drawdown")], F.col("duration").cast("long").alias("duration"))


@query(oracle("""WITH t AS (SELECT max(date) AS t FROM quotes), p AS (SELECT date, code FROM quotes WHERE (key + day_idx) % 3 = 0), e AS (SELECT code, close AS c FROM quotes, t WHERE date = t), i AS (SELECT date, open FROM series WHERE series_id = 'N'),
  x AS (SELECT max(close) AS e FROM series, t WHERE series_id = 'N' AND date = t) SELECT date, code, round(c / nullif(q.open, 0) - 1, 6) AS ret, round(c / nullif(q.open, 0) - 1 - (e / nullif(i.open, 0) - 1), 6) AS alpha_n FROM p JOIN quotes q USING (date, code) JOIN e USING (code) LEFT JOIN i USING (date) CROSS JOIN x""", "quotes", "series"))
def j19_reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    index = panels.series(spark, sf_dir).where("series_id = 'N'")
    picks = q.where("(key + day_idx) % 3 = 0").select("date", "code")
    return pf.rounded(pf.reviewed(picks, q, {"n": index}), ["date", "code"], ["ret", "alpha_n"])


@query(oracle("WITH n AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY date) AS rn, lag(close) OVER (PARTITION BY code ORDER BY date) AS pc FROM quotes) SELECT date, code, "
  + ", ".join(f"round({full('avg(close)', 'close', n)}, 4) AS MA_{n}D, round(close / nullif(lag(close, {n}) OVER (PARTITION BY code ORDER BY date), 0) - 1, 6) AS RET_{n}D, round(CASE WHEN rn > {n} THEN sum(sign(close - pc) * volume) OVER {w(n)} END, 2) AS OBV_DIFF_{n}D, round({full('sum(turnover)', 'turnover', n)}, 6) AS TURNOVER_ROLLING_SUM_{n}D" for n in (2, 5, 10, 20, 30, 60)) + " FROM n", "quotes"))
def d23_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages, returns, balances and turnover sums of the price bundle."""
    digits = {"MA": 4, "RET": 6, "OBV_DIFF": 2, "TURNOVER_ROLLING_SUM": 6}
    shown = {f"{c}_{n}D": d for n in (2, 5, 10, 20, 30, 60) for c, d in digits.items()}
    return bundle_features(panels.quotes(spark, sf_dir), R, BUNDLES["price"], tuple(shown), lambda c: (shown[c], 0.0)).select("date", "code", *shown)


@query()
def d23_full_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price, volume and recursive features of a code's bars side by side."""
    lags = (2, 5, 10, 20, 30, 60)
    names = ["STOCH_K_14D", "STOCH_D_14D", "VR_14D", *[f"MA_{n}D" for n in lags], *[f"STD_{n}D" for n in lags if n >= 5], *[f"{p}MA_{n}D" for p in ("V", "AMT") for n in lags]]
    names += ["EMA_5D", "EMA_20D", "MACD_DIF_12_26D", "MACD_DEA_12_26_7D", "MACD_12_26_7D", "RSI_14D", "ADX_14D"]
    found = bundle_features(panels.quotes(spark, sf_dir), R, Bundle((PRICE, VOLUME, AMOUNT), bars=True), tuple(names))
    return found.select("date", "code", *names)


@query(oracle(f"""WITH r AS (SELECT q.date, code, industry, close / nullif(lag(close, 5) OVER (PARTITION BY code ORDER BY q.date), 0) - 1 AS r5, close, FREE_MRK_CAP AS c FROM quotes q JOIN valuation USING (date, code) JOIN description USING (code)),
  i AS (SELECT date, industry, round(sum(close * c) / sum(c), 3) AS px FROM r GROUP BY ALL), ir AS (SELECT date, industry, px / nullif(lag(px, 5) OVER (PARTITION BY industry ORDER BY date), 0) - 1 AS i5 FROM i),
  e AS (SELECT date, code, round(r5 - i5, 6) AS e5 FROM r JOIN ir USING (date, industry)), k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY e5 DESC, code) AS rank FROM e WHERE e5 IS NOT NULL) SELECT date, code, e5 AS excess, rank FROM k WHERE rank <= 5""", "quotes", "valuation", "description"))
def flagship_top_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, 5-day returns, cap-weighted industry index, excess return over it, and the five best codes of each date."""
    d = panels.description(spark, sf_dir).select("code", "industry")
    caps = panels.valuation(spark, sf_dir).select("date", "code", F.col("FREE_MRK_CAP").alias("w"))
    q = panels.quotes(spark, sf_dir).select("date", "code", "close").withColumn("RET_5D", R.ret("close", 5)).join(caps, ["date", "code"]).join(d, "code")
    index = cs.weighted_index(q, ["date", "industry"], ["close"], "w").withColumn("close", F.round("close", 3))
    moves = index.select("date", "industry", Rows(key=("industry",)).ret("close", 5).alias("RET_5D"))
    e = cs.excess(q, moves, ["date", "industry"], ["RET_5D"]).withColumn("excess", F.round("EXCESSIVE_RET_5D", 6)).where("excess IS NOT NULL")
    return pf.top_k(e, "excess", 5).select("date", "code", "excess", F.col("rank").cast("long").alias("rank"))
