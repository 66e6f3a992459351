"""Queries A1-A13 and B1-B22: loads and cleaning."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.functions import clean
from quantloom.operators import dimensions as dim
from quantloom.operators.rolling import Rows
from quantloom.plans.registry import query
from quantloom.sources import io, panels, sink
from quantloom.sources.panels import oracle

R = Rows()
EARLY, LATE = "1996-06-30", "1996-06-01"


@query("SELECT l_orderkey, CAST(l_shipdate AS DATE) AS ship, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1995-04-01' AND l_returnflag = 'R'")
def a1_projected_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = io.load(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_shipdate", "l_quantity"], date_field="l_shipdate", start="1995-01-01", end="1995-03-31", condition="l_returnflag = 'R'")
    return df.select("l_orderkey", F.to_date("l_shipdate").alias("ship"), "l_quantity")


@query(oracle("SELECT date, code, round(proba_1_2D, 9) AS proba_1_2D, round(proba_1_5D, 9) AS proba_1_5D FROM predictions", "predictions"))
def a2_score_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch(spark, "scores")
    p = panels.predictions(spark, sf_dir).select("date", "code", "proba_1_2D", "proba_1_5D", F.year("date").alias("year"), F.quarter("date").alias("season"))
    p.write.partitionBy("year", "season").option("header", True).csv(path)
    return io.read_scores(spark, f"{path}/*/*", ("proba_1_2D", "proba_1_5D")).select("date", "code", F.round("proba_1_2D", 9).alias("proba_1_2D"), F.round("proba_1_5D", 9).alias("proba_1_5D"))


CODES = ["600004", "002001", "300002", "000003"]
IN_CODES = "('" + "', '".join(CODES) + "')"


@query(oracle(f"SELECT date, code, turnover AS weight FROM quotes WHERE code IN {IN_CODES} AND turnover > 0", "quotes"))
def a3_long_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.long_weights(io.wide_prices(panels.quotes(spark, sf_dir), CODES, "turnover"), CODES)


@query(oracle("SELECT date, " + ", ".join(f"""avg(close) FILTER (code = '{c}') AS "{c}" """ for c in CODES) + " FROM quotes GROUP BY date", "quotes"))
def a4_wide_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.wide_prices(panels.quotes(spark, sf_dir), CODES)


@query(oracle("SELECT date, code, CASE WHEN day_idx % 7 > 1 THEN close END AS v FROM quotes", "quotes"))
def a5_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, path = panels.quotes(spark, sf_dir), io.scratch(spark, "stored")
    odd = F.when(F.col("day_idx") % 7 == 0, F.lit(float("inf"))).when(F.col("day_idx") % 7 == 1, F.lit(float("nan"))).otherwise(F.col("close"))
    io.store(q.select("date", "code", odd.alias("v"), F.year("date").alias("year")), path, partition="year")
    return spark.read.parquet(path).select("date", "code", "v")


@query(oracle("SELECT date, code, close FROM quotes WHERE date < DATE '1996-01-01' OR date > DATE '1996-03-31' UNION ALL SELECT date, code, close + 1 FROM quotes WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' AND (key + day_idx) % 2 = 0", "quotes").replace("DATE '1996-01-01'", "(SELECT min(date) FROM quotes WHERE date >= DATE '1996-01-01' AND (key + day_idx) % 2 = 0)").replace("DATE '1996-03-31'", "(SELECT max(date) FROM quotes WHERE date <= DATE '1996-03-31' AND (key + day_idx) % 2 = 0)"))
def a6_replace_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    new = q.where("date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' AND (key + day_idx) % 2 = 0").select("date", "code", (F.col("close") + 1).alias("close"))
    return io.replace_range(q.select("date", "code", "close"), new)


@query(oracle("""SELECT date, code, close FROM quotes WHERE date NOT BETWEEN DATE '1995-12-10' AND DATE '1996-04-20'
  UNION ALL SELECT date, code, close + 1 FROM quotes WHERE date BETWEEN DATE '1996-01-05' AND DATE '1996-03-31' AND (key + day_idx) % 2 = 0""", "quotes"))
def a6_partition_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of dates is replaced twice in a table of months, by rows that lack some of its dates."""
    q, path = panels.quotes(spark, sf_dir), io.scratch(spark, "months")
    first, last = q.agg(F.min("date"), F.max("date")).first()
    sink.replace_dates(q.select("date", "code", "close"), path, first or date.min, last or date.min)
    new = q.where("date BETWEEN DATE '1996-01-05' AND DATE '1996-03-31' AND (key + day_idx) % 2 = 0").select("date", "code", (F.col("close") + 1).alias("close"))
    for _ in range(2):
        sink.replace_dates(new, path, date(1995, 12, 10), date(1996, 4, 20))
    return sink.stored_dates(spark, path).select("date", "code", "close")


@query(oracle("""WITH new AS (SELECT date, code, close + 1 AS close FROM quotes WHERE key % 3 = 0 AND day_idx % 10 = 0 AND date >= DATE '1996-01-01'), f AS (SELECT code, min(date) AS first FROM new GROUP BY code)
  SELECT date, code, close FROM quotes LEFT JOIN f USING (code) WHERE first IS NULL OR date < first UNION ALL SELECT date, code, close FROM new""", "quotes"))
def a7_replace_from_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    new = q.where("key % 3 = 0 AND day_idx % 10 = 0 AND date >= DATE '1996-01-01'").select("date", "code", (F.col("close") + 1).alias("close"))
    return io.replace_from_first(q.select("date", "code", "close"), new)


@query(oracle(f"""WITH l AS (SELECT max(date) AS d FROM quotes WHERE date <= DATE '{EARLY}') SELECT 'incremental' AS action, d AS last_date, (SELECT c2.date FROM calendar c1, calendar c2 WHERE c1.date = d AND c2.day_idx = greatest(c1.day_idx - 252, 0)) AS lookback_start FROM l""", "quotes"))
def a8_load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    return io.load_plan(q, q.where(f"date <= DATE '{EARLY}'"), panels.calendar(spark, sf_dir), (5, 20, 60), today=date(1998, 12, 1))


@query(oracle(f"SELECT * FROM (SELECT date, code, round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END, 4) AS MA_20D FROM quotes WINDOW w AS (PARTITION BY code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) WHERE date > DATE '{EARLY}'", "quotes"))
def a9_incremental_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookback is the earliest date that any code needs for its 20 rows before the new ones."""
    q = panels.quotes(spark, sf_dir).select("date", "code", "close")
    newest = q.where(f"date <= DATE '{EARLY}'").withColumn("n", F.row_number().over(R.window.partitionBy("code").orderBy(F.desc("date")))).where("n <= 20")
    start = newest.agg(F.min("date")).first()[0]
    return io.recompute(q, lambda df: df.select("date", "code", F.round(R.sma("close", 20), 4).alias("MA_20D")), date.fromisoformat(EARLY), start)


@query(oracle("SELECT date, code, close, 1 AS source_id FROM quotes", "quotes"))
def a10_first_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    rows = q.select("date", "code", "close")
    return io.first_complete([q.where("day_idx % 50 <> 3").select("date", "code", "close"), rows, rows], panels.calendar(spark, sf_dir))


@query(oracle("WITH f AS (SELECT date, code, proba_1_5D FROM predictions WHERE day_idx % 5 <> 0 AND key % 2 = 0), b AS (SELECT date, code, proba_1_5D / 2 AS proba_1_5D FROM predictions) SELECT date, code, round(proba_1_5D, 9) AS proba_1_5D, 0 AS is_backup FROM f UNION ALL SELECT date, code, round(proba_1_5D, 9), 1 FROM b WHERE date NOT IN (SELECT date FROM f)", "predictions"))
def a10_dated_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panels.predictions(spark, sf_dir)
    backup = p.select("date", "code", (F.col("proba_1_5D") / 2).alias("proba_1_5D"))
    found = io.dated_fallback(p.where("day_idx % 5 <> 0 AND key % 2 = 0").select("date", "code", "proba_1_5D"), backup)
    return found.select("date", "code", F.round("proba_1_5D", 9).alias("proba_1_5D"), "is_backup")


@query(oracle(f"SELECT date, code, close FROM quotes WHERE date > DATE '{EARLY}'", "quotes"))
def a11_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir).select("date", "code", "close")
    return io.only_new(q.where(f"date <= DATE '{EARLY}'"), q.where(f"date >= DATE '{LATE}'"), ["date", "code"])


@query(oracle(f"SELECT (SELECT max(date) FROM quotes) AS date, code, close FROM quotes WHERE date = (SELECT max(date) FROM quotes WHERE date <= DATE '{EARLY}')", "quotes"))
def a12_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    return io.latest(q.where(f"date <= DATE '{EARLY}'").select("date", "code", "close"), q)


@query(oracle(f"SELECT 'load' AS what, date, 0::BIGINT AS n FROM calendar WHERE date > (SELECT max(date) FROM quotes WHERE date <= DATE '{EARLY}') UNION ALL SELECT 'kept', date, count(*) FROM quotes WHERE date <= DATE '{EARLY}' GROUP BY date", "quotes"))
def a13_in_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir).select("date", "code", "close")
    kept, _, days = io.in_step(q, q.where(f"date <= DATE '{EARLY}'"), panels.calendar(spark, sf_dir))
    return days.select(F.lit("load").alias("what"), "date", F.lit(0).cast("long").alias("n")).unionByName(kept.groupBy("date").agg(F.count("*").alias("n")).select(F.lit("kept").alias("what"), "date", "n"))


@query(oracle("SELECT date, code AS ticker, volume::BIGINT AS vol, NULL::INT AS mark FROM quotes", "quotes"))
def b1_rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir).select("date", "code", "volume", F.concat("code", F.lit("x")).alias("m"))
    return clean.renamed_and_cast(q, {"code": "ticker", "volume": "vol", "m": "mark"}, {"vol": "bigint", "mark": "int"})


@query(oracle("SELECT date, code, CASE key % 3 WHEN 0 THEN (amount % 1000) * 100000000 WHEN 1 THEN (amount % 1000) * 10000 ELSE amount END AS v FROM quotes", "quotes"))
def b2_chinese_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = (F.col("amount") % 1000).cast("bigint").cast("string")
    text = F.when(F.col("key") % 3 == 0, F.concat(small, F.lit("亿"))).when(F.col("key") % 3 == 1, F.concat(small, F.lit("万"))).otherwise(F.col("amount").cast("bigint").cast("string"))
    return panels.quotes(spark, sf_dir).select("date", "code", clean.chinese_number(text).alias("v"))


@query(oracle("SELECT date, code, CASE day_idx % 13 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE volume END AS v FROM quotes", "quotes"))
def b3_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("day_idx") % 13
    text = F.when(d == 0, "-").when(d == 1, "null").when(d == 2, "--").when(d == 3, "").otherwise(F.col("volume").cast("string"))
    return panels.quotes(spark, sf_dir).select("date", "code", clean.sentinel_number(text).alias("v"))


@query(oracle("SELECT date, code, CASE WHEN key % 2 = 0 THEN round(volume / 100, 6) ELSE amount END AS v FROM quotes", "quotes"))
def b4_percent_thousands(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("key") % 2 == 0, F.concat(F.col("volume").cast("string"), F.lit("%"))).otherwise(F.format_number("amount", 0))
    return panels.quotes(spark, sf_dir).select("date", "code", F.round(clean.percent_number(text), 6).alias("v"))


@query(oracle("SELECT date, code, date AS parsed, date - 1 AS session FROM quotes", "quotes"))
def b5_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("key") % 3
    text = F.when(k == 0, F.date_format("date", "yyyyMMdd")).when(k == 1, F.date_format("date", "yyyy年M月d日")).otherwise(F.concat(F.col("date").cast("string"), F.lit(" 15:00:00")))
    return panels.quotes(spark, sf_dir).select("date", "code", clean.date_text(text).alias("parsed"), clean.us_session_date(text).alias("session"))


@query(oracle("SELECT DISTINCT code FROM quotes WHERE key % 5 <> 0", "quotes"))
def b6_vendor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir).select(F.when(F.col("key") % 5 == 0, F.lit("900001.SH")).otherwise(F.concat("code", F.lit(".SZ"))).alias("vendor"))
    codes = q.select(clean.bare_code("vendor").alias("code"))
    return codes.where(~clean.is_b_share("code")).distinct()


MARKET = "CASE WHEN code LIKE '60%' THEN 'SH' WHEN code LIKE '002%' THEN 'SMEB' WHEN code LIKE '300%' THEN 'GEB' ELSE 'SZ' END"


@query(oracle(f"SELECT code, {MARKET} AS market, count(*) AS n FROM quotes GROUP BY ALL", "quotes"))
def b7_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.quotes(spark, sf_dir).groupBy("code", clean.market_of("code").alias("market")).agg(F.count("*").alias("n"))


@query(oracle("SELECT date, CASE series_id WHEN 'A' THEN 'first' WHEN 'N' THEN 'second' ELSE 'benchmark' END AS market, close FROM series", "series"))
def b8_named_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = panels.series(spark, sf_dir).select("date", F.col("series_id").alias("code"), "close")
    markets, benchmark = dim.named_markets(index, {"A": "first", "N": "second"}, "R")
    return markets.unionByName(benchmark.withColumn("market", F.lit("benchmark"))).select("date", "market", "close")


@query(oracle("SELECT date, key, price AS first_price FROM (SELECT *, row_number() OVER (PARTITION BY date, key ORDER BY ord) AS n FROM lines) WHERE n = 1", "lines"))
def b9_first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.first_by_key(panels.lines(spark, sf_dir), ["date", "key"], [F.col("ord")]).select("date", "key", F.col("price").alias("first_price"))


@query(oracle("SELECT date, code, open * (1 + key % 3) AS open, high * (1 + key % 3) AS high, low * (1 + key % 3) AS low, close * (1 + key % 3) AS close, amount * (1 + key % 3) AS amount FROM quotes", "quotes"))
def b10_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    factors = q.select("date", "code", (1 + F.col("key") % 3).cast("double").alias("adj_factor"))
    return dim.adjusted_quotes(q, factors).select("date", "code", "open", "high", "low", "close", "amount")


@query(oracle("SELECT date, code, close, CASE WHEN day_idx % 3 <> 0 THEN turnover END AS turnover FROM quotes", "quotes"))
def b11_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    return dim.with_turnover(q.select("date", "code", "close", "turnover"), q.where("day_idx % 3 <> 0"))


@query(oracle("SELECT date, series_id, value FROM vals WHERE date IN (SELECT date FROM calendar)", "calendar", "vals"))
def b12_trade_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.on_trade_days(panels.values(spark, sf_dir), panels.calendar(spark, sf_dir))


@query(oracle("SELECT date, code, ST_FLAG, HS300_FLAG FROM flags", "flags"))
def b13_member_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    return dim.member_flags(q.select("date", "code"), {"ST_FLAG": q.where("(key + day_idx) % 17 = 0"), "HS300_FLAG": q.where("key % 3 = 0")})


_MERGE = "WITH m AS (SELECT date, code, CASE WHEN day_idx % 4 <> 0 THEN close END AS a, CASE WHEN day_idx % 5 <> 0 THEN close + key % 2 END AS b, volume AS c, CASE WHEN day_idx % 6 <> 0 THEN volume + key % 2 END AS d FROM quotes) "


@query(oracle(_MERGE + "SELECT date, code, coalesce(a, b) AS close, coalesce(d, c) AS volume FROM m", "quotes"))
def b14_merged_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    a = q.select("date", "code", F.when(F.col("day_idx") % 4 != 0, F.col("close")).alias("close"), "volume")
    b = q.select("date", "code", F.when(F.col("day_idx") % 5 != 0, F.col("close") + F.col("key") % 2).alias("close"), F.when(F.col("day_idx") % 6 != 0, F.col("volume") + F.col("key") % 2).alias("volume"))
    return dim.merged_sources(a, b, ["date", "code"], ["close", "volume"], left_wins=["close"])[0]


@query(oracle(_MERGE + "SELECT count(*) FILTER (abs(a - b) > 0.01) AS close, count(*) FILTER (abs(c - d) > 0.01) AS volume FROM m", "quotes"))
def b14_discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    a = q.select("date", "code", F.when(F.col("day_idx") % 4 != 0, F.col("close")).alias("close"), "volume")
    b = q.select("date", "code", F.when(F.col("day_idx") % 5 != 0, F.col("close") + F.col("key") % 2).alias("close"), F.when(F.col("day_idx") % 6 != 0, F.col("volume") + F.col("key") % 2).alias("volume"))
    return dim.merged_sources(a, b, ["date", "code"], ["close", "volume"], left_wins=["close"])[1]


@query(oracle("""WITH o AS (SELECT date, code, CASE WHEN day_idx % 4 <> 0 THEN close END AS close FROM quotes WHERE key % 3 <> 0), n AS (SELECT date, code, close + 1 AS close FROM quotes WHERE day_idx % 2 = 0)
  SELECT coalesce(o.date, n.date) AS date, coalesce(o.code, n.code) AS code, coalesce(o.close, n.close) AS close, o.code IS NULL OR (o.close IS NULL AND n.close IS NOT NULL) AS touched FROM o FULL JOIN n ON o.date = n.date AND o.code = n.code""", "quotes"))
def b15_fill_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir)
    old = q.where("key % 3 <> 0").select("date", "code", F.when(F.col("day_idx") % 4 != 0, F.col("close")).alias("close"))
    return dim.fill_upsert(old, q.where("day_idx % 2 = 0").select("date", "code", (F.col("close") + 1).alias("close")), ["date", "code"], ["close"])


@query(oracle("""WITH s AS (SELECT date, code, PE_TTM, PE_TTM / 2 AS PS_TTM FROM valuation WHERE day_idx % 3 <> 0) SELECT * FROM s UNION ALL
  SELECT date, code, round(FREE_MRK_CAP / nullif(amount, 0), 6), round(close / nullif(volume, 0), 6) FROM valuation JOIN quotes USING (date, code) WHERE valuation.day_idx % 3 = 0""", "quotes", "valuation"))
def b16_supplemented_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, q = panels.valuation(spark, sf_dir), panels.quotes(spark, sf_dir)
    cap = v.select("date", "code", F.col("FREE_MRK_CAP").alias("cap")).join(q.select("date", "code", "close"), ["date", "code"])
    profit = q.select("date", "code", F.col("amount").alias("profit_ttm"), F.col("volume").alias("sales_ttm"))
    source = v.where("day_idx % 3 <> 0").withColumn("PS_TTM", F.col("PE_TTM") / 2)
    return dim.supplemented_valuation(source, cap, profit).withColumns({c: F.round(c, 6) for c in ("PE_TTM", "PS_TTM")})


@query(oracle("""WITH e AS (SELECT *, (make_date(fiscal_year, fiscal_season * 3, 28))::DATE AS pe, (report_date + INTERVAL (CASE key % 4 WHEN 0 THEN 0 WHEN 1 THEN -12 WHEN 2 THEN 12 ELSE 36 END) MONTH)::DATE AS d FROM reports WHERE day(report_date) < 29),
  x AS (SELECT *, (d + INTERVAL 12 MONTH)::DATE AS later, (d - INTERVAL 12 MONTH)::DATE AS earlier, DATE '1998-12-31' AS now FROM e)
  SELECT code, period, CASE WHEN d >= pe AND d <= now THEN d WHEN later >= pe AND later <= now THEN later WHEN earlier >= pe AND earlier <= now THEN earlier END AS repaired FROM x""", "reports"))
def b17_report_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = panels.reports(spark, sf_dir).where("day(report_date) < 29").withColumn("pe", F.make_date("fiscal_year", F.col("fiscal_season") * 3, F.lit(28)))
    off = F.when(F.col("key") % 4 == 0, 0).when(F.col("key") % 4 == 1, -12).when(F.col("key") % 4 == 2, 12).otherwise(36)
    return r.select("code", "period", clean.repaired_report_date(F.add_months("report_date", off), "pe", F.lit("1998-12-31").cast("date")).alias("repaired"))


@query(oracle("""WITH k AS (SELECT series_id, min(date) AS first FROM vals GROUP BY series_id) SELECT c.date, k.series_id, (SELECT arg_max(value, v.date) FROM vals v WHERE v.series_id = k.series_id AND v.date <= c.date AND v.date IN (SELECT date FROM calendar)) AS value
  FROM calendar c JOIN k ON c.date >= first""", "calendar", "vals"))
def b18_carried_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.carried_forward(panels.values(spark, sf_dir), panels.calendar(spark, sf_dir), ["value"]).select("date", "series_id", "value")


@query(oracle("SELECT code, period, (make_date(fiscal_year, 1, 1) + INTERVAL (3 * fiscal_season) MONTH + INTERVAL 14 DAY)::DATE AS season_known, (make_date(fiscal_year, fiscal_season, 1) + INTERVAL 1 MONTH + INTERVAL 14 DAY)::DATE AS month_known FROM reports", "reports"))
def b19_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.reports(spark, sf_dir).select("code", "period", clean.announced_season("fiscal_year", "fiscal_season").alias("season_known"), clean.announced_month("fiscal_year", "fiscal_season").alias("month_known"))


@query(oracle("WITH s AS (SELECT *, lead(announced) OVER (ORDER BY announced) AS upto FROM macro) SELECT date, m0 FROM calendar JOIN s ON date >= announced AND (upto IS NULL OR date < upto)", "calendar", "macro"))
def b20_known_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.known_daily(panels.macro(spark, sf_dir), panels.calendar(spark, sf_dir), ["m0"])


@query(oracle("""WITH s AS (SELECT *, lead(announced) OVER (ORDER BY announced) AS upto FROM macro), a AS (SELECT date, m0 FROM calendar JOIN s ON date >= announced AND (upto IS NULL OR date < upto)),
  q AS (SELECT year, (month - 1) // 3 + 1 AS season, sum(m0) AS sales, (make_date(year, 1, 1) + INTERVAL 3 MONTH * ((month - 1) // 3 + 1) + INTERVAL 14 DAY)::DATE AS announced FROM macro GROUP BY ALL), u AS (SELECT *, lead(announced) OVER (ORDER BY announced) AS upto FROM q),
  b AS (SELECT date, sales FROM calendar JOIN u ON date >= announced AND (upto IS NULL OR date < upto)) SELECT coalesce(a.date, b.date) AS date, m0, sales FROM a FULL JOIN b ON a.date = b.date""", "calendar", "macro"))
def b20_joined_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly and quarterly figures side by side on the trade days that either covers."""
    m = panels.macro(spark, sf_dir)
    by_season = m.groupBy("year", F.ceil(F.col("month") / 3).cast("int").alias("season")).agg(F.sum("m0").alias("sales")).withColumn("announced", clean.announced_season("year", "season"))
    return dim.joined_daily([(m, ["m0"]), (by_season, ["sales"])], panels.calendar(spark, sf_dir))


@query(oracle("SELECT unnest(generate_series(announced, announced + INTERVAL 1 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS date, m0 FROM macro", "macro"))
def b21_month_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.month_span(panels.macro(spark, sf_dir), ["m0"])


@query(oracle("SELECT code, min(date) AS first_date, max(date) AS last_date FROM quotes GROUP BY code", "quotes"))
def b22_code_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.code_ranges(panels.quotes(spark, sf_dir))


@query(oracle("SELECT code FROM description WHERE code NOT IN (SELECT code FROM quotes WHERE key % 4 <> 0)", "quotes", "description"))
def b22_not_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.not_loaded(panels.description(spark, sf_dir), panels.quotes(spark, sf_dir).where("key % 4 <> 0"))
