"""Queries G1-G14, H1-H5, I1-I10 and J12: assembly, timing and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.functions.clean import notch
from quantloom.operators import assemble as asm
from quantloom.operators import evaluate as ev
from quantloom.operators import timing as tm
from quantloom.operators.rolling import Rows, list_days
from quantloom.plans.registry import query
from quantloom.sources import panels
from quantloom.sources.io import kept, latest, scratch
from quantloom.sources.panels import oracle
from quantloom.sources.sink import replace_dates, stored_dates

R = Rows()


@query(oracle("SELECT date, code, q.close AS close, PE_TTM AS v_PE_TTM, FREE_MRK_CAP AS v_FREE_MRK_CAP, ST_FLAG, HS300_FLAG FROM quotes q LEFT JOIN (SELECT * FROM valuation WHERE day_idx % 3 <> 0) v USING (date, code) LEFT JOIN flags USING (date, code)", "quotes", "valuation", "flags"))
def g1_wide_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = panels.valuation(spark, sf_dir).where("day_idx % 3 <> 0")
    v = v.unionByName(v.where("day_idx % 5 = 0"))
    return asm.wide_panel(panels.quotes(spark, sf_dir).select("date", "code", "close"), [asm.Part(v, ("date", "code"), "v_", ("key", "day_idx", "TOT_MRK_CAP")), asm.Part(panels.flags(spark, sf_dir), ("date", "code"))])


@query(oracle("""WITH a AS (SELECT date, code, close, industry FROM quotes JOIN description USING (code)), i AS (SELECT date, industry, avg(close) AS c FROM a GROUP BY ALL), s AS (SELECT date, close FROM series WHERE series_id = 'A')
  SELECT date, code, a.close AS close, industry, round(c, 3) AS industry_close, s.close AS index_close FROM a LEFT JOIN i USING (date, industry) LEFT JOIN s USING (date)""", "quotes", "description", "series"))
def g2_category_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = panels.description(spark, sf_dir).select("code", "industry")
    a = panels.quotes(spark, sf_dir).select("date", "code", "close").join(d, "code")
    by_industry = a.groupBy("date", "industry").agg(F.round(F.avg("close"), 3).alias("close"))
    index = panels.series(spark, sf_dir).where("series_id = 'A'").select("date", "close")
    return asm.wide_panel(a, [asm.Part(by_industry, ("date", "industry"), "industry_", small=True), asm.Part(index, ("date",), "index_", small=True)])


@query(oracle("""WITH a AS (SELECT date, code, close, industry FROM quotes LEFT JOIN (SELECT code, industry FROM description) USING (code)), i AS (SELECT date, industry, round(avg(close), 3) AS industry_close FROM a GROUP BY ALL),
  s AS (SELECT date, close AS index_close FROM series WHERE series_id = 'A')
  SELECT date, code, close, industry, v.PE_TTM AS v_PE_TTM, v.FREE_MRK_CAP AS v_FREE_MRK_CAP, ST_FLAG, HS300_FLAG, round(proba_1_2D, 6) AS p_proba_1_2D, round(proba_1_20D, 6) AS p_proba_1_20D, Y_2D AS y_Y_2D, Y_20D AS y_Y_20D, t.action AS o_action, industry_close, index_close
  FROM a LEFT JOIN valuation v USING (date, code) LEFT JOIN flags USING (date, code) LEFT JOIN predictions USING (date, code) LEFT JOIN outcomes USING (date, code) LEFT JOIN trades t USING (date, code) LEFT JOIN i USING (date, industry) LEFT JOIN s USING (date)""", "quotes", "description", "series", "valuation", "flags", "predictions", "outcomes", "trades"))
def g1_g2_two_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five parts by (date, code), all read from the buckets of the quotes, then the parts of a category and of a date."""
    industry = panels.description(spark, sf_dir).select("code", "industry")
    anchor = panels.quotes(spark, sf_dir).select("date", "code", "close").join(industry, "code", "left")
    key = ("date", "code")
    parts = [
        asm.Part(panels.valuation(spark, sf_dir), key, "v_", ("key", "day_idx", "TOT_MRK_CAP")), asm.Part(panels.flags(spark, sf_dir), key),
        asm.Part(panels.predictions(spark, sf_dir), key, "p_", ("key", "day_idx", "proba_1_5D", "proba_1_10D")),
        asm.Part(panels.outcomes(spark, sf_dir), key, "y_", ("key", "day_idx", "Y_5D", "Y_10D")), asm.Part(panels.orders(spark, sf_dir), key, "o_", ("day_idx",)),
    ]
    by_industry = anchor.groupBy("date", "industry").agg(F.round(F.avg("close"), 3).alias("close"))
    index = panels.series(spark, sf_dir).where("series_id = 'A'").select("date", "close")
    found = asm.assembled(anchor, [parts, [asm.Part(by_industry, ("date", "industry"), "industry_", small=True), asm.Part(index, ("date",), "index_", small=True)]])
    return found.withColumns({c: F.round(c, 6) for c in ("p_proba_1_2D", "p_proba_1_20D")})


@query(oracle("SELECT date, code, close, area FROM quotes LEFT JOIN description USING (code)", "quotes", "description"))
def g3_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area has no date: it is today's, also for the past."""
    return asm.wide_panel(panels.quotes(spark, sf_dir).select("date", "code", "close"), [asm.Part(panels.description(spark, sf_dir).select("code", "area"), ("code",))])


@query(oracle("SELECT date, code FROM quotes JOIN description USING (code) JOIN flags USING (date, code) WHERE date - list_date > 60 AND ST_FLAG = 0", "quotes", "description", "flags"))
def g4_screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = list_days(panels.quotes(spark, sf_dir).select("date", "code"), panels.description(spark, sf_dir))
    return asm.screened(q.join(panels.flags(spark, sf_dir), ["date", "code"], "left")).select("date", "code")


@query(oracle("SELECT code, " + ", ".join(f"(industry = 'I{k}')::INT AS industry_I{k}" for k in range(7)) + " FROM description", "description"))
def g5_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asm.one_hot(panels.description(spark, sf_dir), {"industry": [f"I{k}" for k in range(7)]}).select("code", *[f"industry_I{k}" for k in range(7)])


@query(oracle("""WITH l AS (SELECT code, PE_TTM FROM valuation WHERE date = (SELECT max(date) FROM valuation WHERE date <= DATE '1997-06-30')), a AS (SELECT date, code, close FROM quotes WHERE date = (SELECT max(date) FROM quotes))
  SELECT date, code, close, PE_TTM AS v_PE_TTM FROM a LEFT JOIN l USING (code)""", "quotes", "valuation"))
def g6_live_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = panels.quotes(spark, sf_dir).select("date", "code", "close")
    newest = latest(q, q)
    v = latest(panels.valuation(spark, sf_dir).where("date <= DATE '1997-06-30'").select("date", "code", "PE_TTM"), q)
    return asm.wide_panel(newest, [asm.Part(v, ("date", "code"), "v_")])


@query(oracle("SELECT date, close, " + ", ".join(f"""coalesce((m = {v})::INT, 0) AS "m:{v}" """ for v in range(4)) + " FROM (SELECT date, close, day_idx % 4 AS m FROM series WHERE series_id = 'A')", "series"))
def g7_timing_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = panels.series(spark, sf_dir).where("series_id = 'A'").select("date", "close", (F.col("day_idx") % 4).cast("double").alias("m"))
    return asm.rounded_one_hot(index, "m").drop("m")


@query(oracle("SELECT 'train' AS part, date, code, Y_5D FROM outcomes WHERE Y_5D IS NOT NULL UNION ALL SELECT 'test', date, code, coalesce(Y_5D, 0) FROM outcomes", "outcomes"))
def g8_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, y = panels.quotes(spark, sf_dir).select("date", "code"), panels.outcomes(spark, sf_dir)
    train, test = asm.labelled(q, y, "Y_5D", training=True), asm.labelled(q, y, "Y_5D", training=False)
    return train.select(F.lit("train").alias("part"), "date", "code", "Y_5D").unionByName(test.select(F.lit("test").alias("part"), "date", "code", "Y_5D"))


BUCKET = "(" + " + ".join(f"(instr('0123456789abcdef', md5('0|' || date || '|' || code)[{i + 1}]) - 1) * {16 ** (5 - i)}" for i in range(6)) + ")"


@query(oracle(f"SELECT date, code, CASE WHEN {BUCKET} % 10 < 9 THEN 'train' ELSE 'test' END AS part FROM quotes", "quotes"))
def g9_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = asm.hash_split(panels.quotes(spark, sf_dir).select("date", "code"), "date", "code")
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))


@query(oracle(f"SELECT date, code FROM quotes WHERE year(date) = 1997 OR (year(date) < 1997 AND {BUCKET} % 100 < 20)", "quotes"))
def g10_past_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asm.past_sample(panels.quotes(spark, sf_dir).select("date", "code"), F.year("date"), 1997, "date", "code")


@query(oracle("SELECT Y_5D, (SELECT min(n) FROM (SELECT count(*) AS n FROM outcomes WHERE Y_5D IS NOT NULL GROUP BY Y_5D)) AS n FROM outcomes WHERE Y_5D IS NOT NULL GROUP BY Y_5D", "outcomes"))
def g11_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asm.balanced(panels.outcomes(spark, sf_dir).select("date", "code", "Y_5D"), "Y_5D", "date", "code").groupBy("Y_5D").agg(F.count("*").alias("n"))


PLAN = """p AS (SELECT y * 10 + s AS window_id, (make_date(y, s * 2 - 1, 1) - INTERVAL 12 MONTH)::DATE AS a, make_date(y, s * 2 - 1, 1) - 31 AS b, make_date(y, s * 2 - 1, 1) AS c, last_day(make_date(y, s * 2, 1)) AS d
  FROM range(1994, 1999) t(y), range(1, 7) u(s) WHERE y < 1998 OR s < 3)"""


@query(oracle(f"WITH {PLAN} SELECT window_id, CASE WHEN date <= b THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM quotes JOIN p ON date BETWEEN a AND b OR date BETWEEN c AND d GROUP BY ALL", "quotes"))
def g12_moving_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = asm.moving_windows(spark, 1994, 1998, (1998, 3))
    return asm.in_windows(panels.quotes(spark, sf_dir).select("date", "code"), plan).groupBy(F.col("window_id").cast("long").alias("window_id"), "part").agg(F.count("*").alias("n"))


_CHAIN = "c AS (SELECT code, date, close, count(*) OVER w AS n, list(close) OVER w AS x FROM quotes WINDOW w AS (PARTITION BY code ORDER BY date ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING))"


@query(oracle(f"WITH {_CHAIN} SELECT code, date, array_to_string(list_transform(x, lambda v: v::BIGINT::VARCHAR), ',') AS chain FROM c WHERE n = 5", "quotes"))
def g13_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = asm.chains(panels.quotes(spark, sf_dir), ["code"], ["close"], 5)
    return found.select("code", "date", F.array_join(F.transform("chain", lambda x: x["close"].cast("bigint").cast("string")), ",").alias("chain"))


@query(oracle("SELECT code, date, close FROM quotes WHERE code IN (SELECT code FROM quotes GROUP BY code HAVING count(*) >= 5)", "quotes"))
def g14_unchained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asm.unchained(asm.chains(panels.quotes(spark, sf_dir), ["code"], ["close"], 5).withColumnRenamed("chain", "predicted"), ["code"])


#: The last one turns often, as the prices of the series move by large factors.
SETTINGS = [(0.2, 0.05), (0.5, 0.1), (0.001, 0.05)]
#: One step of a search from row b on, now at row i with its best row so far at k; sign is 1 for a peak. It ends where t.
_STEP = """SELECT *, sign * (1 - x[i] / x[k]) > chg_threshold AND (x[k] / x[b] = 1 OR sign * (1 - x[i] / x[k]) / (sign * (x[k] / x[b] - 1)) > chg_pct) AS t
  FROM (SELECT w.* EXCLUDE (k), x, n, CASE WHEN sign * (x[i] - x[k]) > 0 THEN i ELSE k END AS k FROM {} w JOIN l USING (series_id) WHERE i <= n)"""
TURNS_SQL = f"""WITH RECURSIVE l AS (SELECT series_id, list(close ORDER BY date) AS x, count(*) AS n FROM series GROUP BY series_id),
  grid(chg_pct, chg_threshold) AS (VALUES {", ".join(f"({p}::DOUBLE, {t}::DOUBLE)" for p, t in SETTINGS)}),
  opening AS (SELECT series_id, chg_pct, chg_threshold, sign, 1::BIGINT AS b, 1::BIGINT AS i, 1::BIGINT AS k, NULL::BIGINT AS mark FROM l, grid, (VALUES (1), (-1)) s(sign)
    UNION ALL SELECT series_id, chg_pct, chg_threshold, sign, b, CASE WHEN t THEN n + 1 ELSE i + 1 END, k, CASE WHEN t THEN k END FROM ({_STEP.format("opening")})),
  firsts AS (SELECT series_id, chg_pct, chg_threshold, max(mark) FILTER (sign = 1) AS peak, max(mark) FILTER (sign = -1) AS trough FROM opening GROUP BY ALL HAVING peak <> trough),
  walk AS (SELECT series_id, chg_pct, chg_threshold, CASE WHEN peak < trough THEN -1 ELSE 1 END AS sign, least(peak, trough) AS b, least(peak, trough) AS i, least(peak, trough) AS k, least(peak, trough) AS mark FROM firsts
    UNION ALL SELECT series_id, chg_pct, chg_threshold, CASE WHEN t OR i = n THEN -sign ELSE sign END, CASE WHEN t THEN k ELSE b END, CASE WHEN t THEN k ELSE i + 1 END, k, CASE WHEN t THEN k WHEN i = n THEN n END FROM ({_STEP.format("walk")})),
  marks AS (SELECT series_id, chg_pct, chg_threshold, mark AS rn, -sign AS label FROM walk WHERE mark IS NOT NULL),
  r AS (SELECT series_id, date, close / lag(close) OVER u AS ret, row_number() OVER u AS rn FROM series WINDOW u AS (PARTITION BY series_id ORDER BY date))
  SELECT series_id, chg_pct, chg_threshold, date, ret, (first_value(label IGNORE NULLS) OVER (PARTITION BY series_id, chg_pct, chg_threshold ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::INT AS label
  FROM (SELECT * FROM r, grid) LEFT JOIN marks USING (series_id, chg_pct, chg_threshold, rn)"""


def _turns(spark, sf_dir) -> DataFrame:
    return tm.label_turns(panels.series(spark, sf_dir), spark.createDataFrame(SETTINGS, "chg_pct double, chg_threshold double"))


@query(oracle(TURNS_SQL, "series"))
def h1_turning_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir)


@query(oracle("SELECT series_id, date, t AS target FROM (SELECT *, lead(CASE WHEN day_idx % 2 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY series_id ORDER BY date) AS t FROM series) WHERE t IS NOT NULL", "series"))
def h2_next_day_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = panels.series(spark, sf_dir).withColumn("label", F.when(F.col("day_idx") % 2 == 0, 1).otherwise(-1))
    return tm.next_day_target(s, ["series_id"]).select("series_id", "date", "target")


GROSS = "g AS (SELECT series_id, date, day_idx, close / nullif(lag(close) OVER (PARTITION BY series_id ORDER BY date), 0) AS ret FROM series)"


@query(oracle(f"WITH {GROSS} SELECT series_id, date, CASE WHEN ret IS NULL THEN NULL WHEN ret <= .97 THEN 0 WHEN ret <= .98 THEN 1 WHEN ret <= .99 THEN 2 WHEN ret <= 1.0 THEN 3 WHEN ret <= 1.01 THEN 4 WHEN ret <= 1.02 THEN 5 WHEN ret <= 1.03 THEN 6 ELSE 7 END AS notch FROM g", "series"))
def h3_notches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Rows(key=("series_id",))
    return panels.series(spark, sf_dir).select("series_id", "date", F.try_divide(F.col("close"), rows.lag("close")).alias("ret")).select("series_id", "date", notch("ret").alias("notch"))


def _valued(spark, sf_dir) -> DataFrame:
    return panels.outcomes(spark, sf_dir).where("Y_5D IS NOT NULL").select("date", "code", "Y_5D").join(panels.quotes(spark, sf_dir).select("date", "code", "close", "volume"), ["date", "code"])


def _binned(spark, sf_dir):
    rows = _valued(spark, sf_dir)
    return rows, tm.chi_merge(rows, ["close", "volume"], "Y_5D")


@query(oracle("""WITH l AS (UNPIVOT (SELECT close::DOUBLE AS close, volume::DOUBLE AS volume FROM quotes JOIN outcomes USING (date, code) WHERE Y_5D IS NOT NULL) ON close, volume INTO NAME "column" VALUE v),
  x AS (SELECT "column", list(v ORDER BY v) AS x FROM l GROUP BY "column"),
  a AS (SELECT "column", x, round((len(x) - 1) * q / 100.0::DOUBLE, 9) AS place FROM x, range(1, 101) t(q))
  SELECT DISTINCT "column", (x[floor(place)::BIGINT + 1] + x[ceil(place)::BIGINT + 1]) / 2 AS upper FROM a""", "quotes", "outcomes"))
def h4_quantile_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut points that H4 starts from."""
    return tm.quantile_cuts(tm.value_counts(_valued(spark, sf_dir), ["close", "volume"], "Y_5D"))


@query()
def h4_chi_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binned(spark, sf_dir)[1]


@query()
def h5_assigned_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cuts = _binned(spark, sf_dir)
    return tm.assigned_bins(rows, cuts, ["close", "volume"])


_QUARTERS = """WITH v AS (SELECT date, code, close::DOUBLE AS close, volume::DOUBLE AS volume FROM quotes JOIN outcomes USING (date, code) WHERE Y_5D IS NOT NULL), x AS (SELECT list(close ORDER BY close) AS xc, list(volume ORDER BY volume) AS xv FROM v),
  u AS (SELECT """ + ", ".join(f"(x{c}[floor((len(x{c}) - 1) * {q} / 4.0::DOUBLE)::BIGINT + 1] + x{c}[ceil((len(x{c}) - 1) * {q} / 4.0::DOUBLE)::BIGINT + 1]) / 2 AS {c}{q}" for c in "cv" for q in range(1, 5)) + " FROM x) "  # fmt: skip


@query(oracle(_QUARTERS + "SELECT date, code, " + ", ".join(f"({f'{c} > {c[0]}{q - 1} AND ' if q > 1 else ''}{c} <= {c[0]}{q})::INT AS {c}_bin_{q - 1}" for c in ("close", "volume") for q in range(1, 5)) + " FROM v, u", "quotes", "outcomes"))
def h5_quarter_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5 on the four bins between the quarters of each column."""
    rows = _valued(spark, sf_dir)
    cuts = tm.quantile_cuts(tm.value_counts(rows, ["close", "volume"], "Y_5D"), 4)
    return tm.assigned_bins(rows.drop("Y_5D"), cuts, ["close", "volume"])


FEATURES = ["ret1", "ret5", "pe"]


def _training(spark, sf_dir) -> DataFrame:
    q = panels.quotes(spark, sf_dir).select("date", "code", R.ret("close", 1).alias("ret1"), R.ret("close", 5).alias("ret5"))
    v = panels.valuation(spark, sf_dir).select("date", "code", F.col("PE_TTM").alias("pe"))
    return q.join(v, ["date", "code"]).join(panels.outcomes(spark, sf_dir).drop("key", "day_idx", "close"), ["date", "code"])


@query()
def i1_i4_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(_training(spark, sf_dir), "training")
    past = rows.where("date < DATE '1997-01-01'")
    models = {f"proba_1_{h}D": ev.train_classifier(past, FEATURES, f"Y_{h}D", rounds=3, depth=2) for h in (2, 5, 10, 20)}
    return ev.score(rows.where("date >= DATE '1997-01-01'"), models)


@query(oracle("SELECT date, code, round(proba_1_5D, 9) AS proba_1_5D FROM predictions", "predictions"))
def i4_stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of the last day are predicted and stored twice, as a live job that is run again does."""
    p, path = panels.predictions(spark, sf_dir).select("date", "code", "proba_1_5D"), scratch(spark, "scores")
    first, last = p.agg(F.min("date"), F.max("date")).first()
    if last is None:
        return p
    replace_dates(p, path, first, last)
    for _ in range(2):
        replace_dates(p.where(F.col("date") == F.lit(last)), path, last, last)
    return stored_dates(spark, path).select("date", "code", F.round("proba_1_5D", 9).alias("proba_1_5D"))


@query()
def i2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The AUC of each setting of the grid, in its order."""
    best = ev.search(_training(spark, sf_dir), FEATURES, "Y_5D", ["date", "code"])
    return spark.createDataFrame([(i, float(m)) for i, m in enumerate(best.validationMetrics)], "setting int, auc double")


@query()
def i2_random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten drawn settings and their AUC on held-out rows."""
    return ev.random_search(_training(spark, sf_dir), FEATURES, "Y_5D", ["date", "code"], settings=ev.drawn_settings(10, 7, depths=(1, 5)), rounds=3)


@query()
def i3_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = ev.train_classifier(_training(spark, sf_dir), FEATURES, "Y_5D", rounds=3, depth=2)
    return ev.importances(spark, model, FEATURES)


def _scored(spark, sf_dir) -> DataFrame:
    p = panels.predictions(spark, sf_dir).select("date", "code", *[f"proba_1_{h}D" for h in (2, 5, 10, 20)])
    return panels.outcomes(spark, sf_dir).join(p, ["date", "code"]).withColumn("year", F.year("date"))


SCORED = "s AS (SELECT year(date) AS year, o.*, proba_1_2D, proba_1_5D, proba_1_10D, proba_1_20D FROM outcomes o JOIN predictions p USING (date, code))"


@query(oracle(f"""WITH {SCORED} SELECT year, t / 100.0::DOUBLE AS threshold, round(count(*) FILTER (proba_1_5D > t / 100.0::DOUBLE AND Y_5D = 1) / nullif(count(*) FILTER (proba_1_5D > t / 100.0::DOUBLE), 0), 9) AS precision,
  round(count(*) FILTER (proba_1_5D > t / 100.0::DOUBLE AND Y_5D = 1) / nullif(count(*) FILTER (Y_5D = 1), 0), 9) AS recall FROM s, range(50, 100, 5) r(t) GROUP BY year, t""", "outcomes", "predictions"))
def i5_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.at_thresholds(_scored(spark, sf_dir), ["year"], "Y_5D", "proba_1_5D").select("year", "threshold", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query(oracle(f"""WITH {SCORED}, k AS (SELECT Y_5D AS y, (proba_1_5D > 0.5)::INT AS p FROM s WHERE Y_5D IS NOT NULL)
  SELECT c AS class, round(count(*) FILTER (y = c AND p = c) / nullif(count(*) FILTER (p = c), 0), 9) AS precision, round(count(*) FILTER (y = c AND p = c) / count(*) FILTER (y = c), 9) AS recall, count(*) FILTER (y = c) AS support,
  round(count(*) FILTER (y = p) / count(*), 9) AS accuracy FROM k, (SELECT unnest([0, 1]) AS c) GROUP BY c""", "outcomes", "predictions"))
def i6_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir).where("Y_5D IS NOT NULL").withColumn("p", (F.col("proba_1_5D") > 0.5).cast("int"))
    return ev.class_report(rows, "Y_5D", "p").select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall")], "support", F.round("accuracy", 9).alias("accuracy"))


@query(oracle(f"""WITH {SCORED}, r AS (SELECT year, Y_5D AS y, rank() OVER w + (count(*) OVER (PARTITION BY year, proba_1_5D) - 1) / 2 AS rk FROM s WHERE Y_5D IS NOT NULL WINDOW w AS (PARTITION BY year ORDER BY proba_1_5D))
  SELECT year, round((sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2) / nullif(count(*) FILTER (y = 1) * count(*) FILTER (y = 0), 0), 9) AS auc FROM r GROUP BY year""", "outcomes", "predictions"))
def i7_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.auc(_scored(spark, sf_dir).where("Y_5D IS NOT NULL"), ["year"], "Y_5D", "proba_1_5D").select("year", F.round("auc", 9).alias("auc"))


@query(oracle(f"""WITH {SCORED}, a AS (SELECT year, proba_1_5D AS x, count(*) FILTER (Y_5D = 1) AS p, count(*) FILTER (Y_5D = 0) AS q FROM s WHERE Y_5D IS NOT NULL GROUP BY ALL)
  SELECT year, round(max(d), 9) AS ks FROM (SELECT year, abs(sum(p) OVER w / sum(p) OVER (PARTITION BY year) - sum(q) OVER w / sum(q) OVER (PARTITION BY year)) AS d FROM a WINDOW w AS (PARTITION BY year ORDER BY x DESC ROWS UNBOUNDED PRECEDING)) GROUP BY year""", "outcomes", "predictions"))
def i8_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.ks(_scored(spark, sf_dir).where("Y_5D IS NOT NULL"), ["year"], "Y_5D", "proba_1_5D").select("year", F.round("ks", 9).alias("ks"))


@query(oracle(f"WITH {SCORED} SELECT date, code, (row_number() OVER (PARTITION BY year ORDER BY proba_1_5D DESC, date, code) <= floor(count(*) OVER (PARTITION BY year) / 100))::INT AS picked FROM s", "outcomes", "predictions"))
def i9_top_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.top_percent(_scored(spark, sf_dir), ["year"], "proba_1_5D", ["date", "code"]).select("date", "code", "picked")


@query(oracle("SELECT date, code, round(proba_1_2D * 0.1 + proba_1_5D * 0.2 + proba_1_10D * 0.3 + proba_1_20D * 0.4, 9) AS blend FROM predictions", "predictions"))
def i10_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = {f"proba_1_{h}D": float(k) for k, h in enumerate((2, 5, 10, 20), 1)}
    return ev.blended(panels.predictions(spark, sf_dir), weights, list(weights)).select("date", "code", F.round("blend", 9).alias("blend"))


@query(oracle(f"""WITH {GROSS}, d AS (SELECT *, CASE WHEN lag(day_idx % 3) OVER (PARTITION BY series_id ORDER BY date) >= 1 THEN coalesce(ret, 1) ELSE 1 END AS day_return FROM g)
  SELECT series_id, date, round(day_return, 6) AS day_return, round(ln(product(day_return) OVER (PARTITION BY series_id ORDER BY date ROWS UNBOUNDED PRECEDING)), 6) AS log_cumulative FROM d""", "series"))
def j12_timing_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Rows(key=("series_id",))
    s = panels.series(spark, sf_dir).select("series_id", "date", (F.col("day_idx") % 3).alias("signal"), F.try_divide(F.col("close"), rows.lag("close")).alias("ret"))
    return tm.timing_profit(s, ["series_id"], "signal").select("series_id", "date", F.round("day_return", 6).alias("day_return"), F.round(F.ln("cumulative"), 6).alias("log_cumulative"))
