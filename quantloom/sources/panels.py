"""Panels that the queries run on, derived by Spark from the given tables (see FIXTURES.md).

Prices and amounts are whole cents in doubles, so that their sums don't depend on the order of the rows. The trade
calendar has a row per day and is the only thing numbered globally; it is small at every size of the other tables.

Bars and the calendar are what all other panels start from. As in a warehouse they are written once, to the cluster's
shared folder, and read from there by every query of the session on the same tables. A table that is written anew gets
new panels; what was written goes when the session's JVM ends. Bars are in buckets of their code and sorted by date, so
windows and sums by code need no exchange; joins by (date, code) still do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantloom.sources.io import scratch
from quantloom.sources.layout import write_buckets


_STORED: dict[tuple[str, str, str, tuple], str] = {}
#: What a line's place within its bar is ordered by.
GIVEN = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes and number of the files of a table, and the time of its folder (or file): another state after each write."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = java.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.getContentSummary(at)
    return found.getLength(), found.getFileCount(), files.getFileStatus(at).getModificationTime()


def _key(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...]) -> tuple[str, str, str, tuple]:
    return spark.sparkContext.applicationId, sf_dir, name, tuple(table_state(spark, f"{sf_dir}/{t}.parquet") for t in tables)


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], *partitions: str) -> DataFrame:
    """A panel of lineitem, written the first time that a session asks for it in the table's present state."""
    key = _key(spark, sf_dir, name, ("lineitem",))
    if key not in _STORED:
        path = scratch(spark, name)
        build().write.partitionBy(*partitions).parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def in_buckets(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], *partitions: str) -> DataFrame:
    """A panel of lineitem, dealt out by code, in buckets of it; written the first time that a session asks for it in the table's present state."""
    key = _key(spark, sf_dir, f"{name} in buckets", ("lineitem",))
    if key not in _STORED:
        _STORED[key] = write_buckets(build(), name, ("code",), order=("code", "date"), dealt=True, partitions=partitions)
    return spark.table(_STORED[key])


def code_text(key: Column) -> Column:
    """Six characters: a market prefix by key % 4, then the key with leading zeros (longer for long keys)."""
    prefix = F.when(key % 4 == 0, "60").when(key % 4 == 1, "002").when(key % 4 == 2, "300").otherwise("000")
    text = key.cast("string")
    return F.concat(prefix, F.lpad(text, F.greatest(F.length(text), 6 - F.length(prefix)), "0"))


def lines(spark: SparkSession, sf_dir: str, *dealt_by: str) -> DataFrame:
    """The lines with what bars are made of; dealt_by (of date, key, flag, code) deals them out as they are, before anything else is derived from them."""
    given, by_code = GIVEN, ["code"] if "code" in dealt_by else []
    raw = read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("flag"), *[c for c in given if c != "l_suppkey"])
    raw = raw.withColumn("code", code_text(F.col("key"))) if by_code else raw
    # A stated number of partitions, so that they can be written as buckets.
    raw = raw.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *dealt_by) if dealt_by else raw
    return raw.withColumn("l_suppkey", F.col("key")).select(
        "date", "key", *by_code, "flag", F.floor(100 * F.col("l_extendedprice") / F.col("l_quantity") + 0.5).cast("double").alias("price"),
        F.col("l_quantity").alias("qty"), F.floor(100 * F.col("l_extendedprice") + 0.5).cast("double").alias("cents"), F.struct(*given).alias("ord"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, day_idx: the trade days, numbered from 0."""
    days = read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).where("date IS NOT NULL").distinct()
    return stored(spark, sf_dir, "calendar", lambda: days.select("date", (F.row_number().over(Window.orderBy("date")) - 1).alias("day_idx")))


def _sums() -> list[Column]:
    return [F.max("price").alias("top"), F.min("price").alias("bottom"), F.sum("qty").alias("volume"), F.sum("cents").alias("amount")]


def _bars(rows: DataFrame, by: list[str], days: DataFrame) -> DataFrame:
    return _shaped(rows.groupBy(*by, "date").agg(F.min_by("price", "ord").alias("open"), F.max_by("price", "ord").alias("close"), *_sums()), by, days)


def _small_bars(rows: DataFrame, by: list[str], days: DataFrame) -> DataFrame:
    """The same for bars of few lines: their first and last line are marked in a window, so that what is summed up are plain numbers."""
    w = Window.partitionBy(*by, "date").orderBy(*[f"ord.{c}" for c in GIVEN])
    marked = rows.select(*by, "date", "price", "qty", "cents", (F.row_number().over(w) == 1).alias("__first"), F.lead(F.lit(1)).over(w).isNull().alias("__last"))
    ends = {"open": F.max(F.when(F.col("__first"), F.col("price"))), "close": F.max(F.when(F.col("__last"), F.col("price")))}
    return _shaped(marked.groupBy(*by, "date").agg(*[v.alias(k) for k, v in ends.items()], *_sums()), by, days)


def _shaped(bars: DataFrame, by: list[str], days: DataFrame) -> DataFrame:
    bars = bars.join(F.broadcast(days), "date")
    rounded = lambda c: F.floor(c + 0.5).cast("double")
    flat = F.col("day_idx") % 12 == 0
    return bars.select(
        "date", *by, "day_idx", "open", rounded(F.when(flat, F.col("top")).otherwise(F.col("top") * (200 + F.col("day_idx") % 4) / 200)).alias("high"),
        rounded(F.when(flat, F.col("bottom")).otherwise(F.col("bottom") * (200 - F.col("day_idx") % 3) / 200)).alias("low"),
        "close", "volume", "amount", (F.col("volume") / 1000).alias("turnover"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, code, key, day_idx, open, high, low, close, volume, amount, turnover, in buckets of code.

    A bar has hardly more than one line, so nothing is gained by adding lines up before they are dealt out, and a line is smaller than the
    first and last one that such a sum carries.
    """
    return in_buckets(spark, sf_dir, "quotes", lambda: _small_bars(lines(spark, sf_dir, "code"), ["code", "key"], calendar(spark, sf_dir)))


def quotes_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quotes, partitioned by year, each in buckets of code."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return in_buckets(spark, sf_dir, "quotes_by_year", lambda: quotes(spark, sf_dir).withColumn("year", F.year("date")).repartition(n, "code"), "year")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of whole return flags, as series_id."""
    return stored(spark, sf_dir, "series", lambda: _bars(lines(spark, sf_dir).withColumnRenamed("flag", "series_id"), ["series_id"], calendar(spark, sf_dir)))


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, series_id, value: order totals in cents by day and priority."""
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("series_id")).agg(F.sum(F.floor(100 * F.col("o_totalprice") + 0.5)).cast("double").alias("value"))


def traded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, code, key, day_idx of the quotes, without their prices."""
    return quotes(spark, sf_dir).select("date", "code", "key", "day_idx")


def first_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, key, first: each code's first trade day, from the bars."""
    return stored(spark, sf_dir, "first_days", lambda: quotes(spark, sf_dir).groupBy("code", "key").agg(F.min("date").alias("first")))


def description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, key, area, industry, list_date."""
    first = first_days(spark, sf_dir)
    s = read(spark, sf_dir, "supplier").join(F.broadcast(read(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.select(F.col("s_suppkey").alias("key"), F.col("n_name").alias("area"))
    return first.join(s, "key").select("code", "key", "area", F.concat(F.lit("I"), (F.col("key") % 7).cast("string")).alias("industry"), F.expr("date_sub(first, CAST(key % 90 AS INT))").alias("list_date"))


def valued_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quotes of known suppliers with their valuation beside them; capital is whole, so that caps are too."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.floor(1000 + F.abs("s_acctbal")).alias("shares"))
    free = (F.col("shares") * F.col("close")).cast("double")
    pe = ((F.col("key") + F.col("day_idx")) % 50 - 5).cast("double")
    return quotes(spark, sf_dir).join(s, "key").withColumns({"FREE_MRK_CAP": free, "TOT_MRK_CAP": 2 * free, "PE_TTM": pe}).drop("shares")


def valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, code, key, day_idx, FREE_MRK_CAP, TOT_MRK_CAP, PE_TTM."""
    return valued_quotes(spark, sf_dir).select("date", "code", "key", "day_idx", "FREE_MRK_CAP", "TOT_MRK_CAP", "PE_TTM")


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = traded(spark, sf_dir)
    return q.select("date", "code", ((F.col("key") + F.col("day_idx")) % 17 == 0).cast("int").alias("ST_FLAG"), (F.col("key") % 3 == 0).cast("int").alias("HS300_FLAG"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = traded(spark, sf_dir)
    return q.select("date", "code", "key", "day_idx", *[((F.col("key") * 7919 + F.col("day_idx") * 1047 * h) % 10007 / 10007.0).alias(f"proba_1_{h}D") for h in (2, 5, 10, 20)])


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: 1 if the close h rows ahead is higher, null in the last h rows of a code."""
    w = Window.partitionBy("code").orderBy("date")
    q = quotes(spark, sf_dir).select("date", "code", "key", "day_idx", "close")
    return q.select("date", "code", "key", "day_idx", *[(F.lead("close", h).over(w) > F.col("close")).cast("int").alias(f"Y_{h}D") for h in (2, 5, 10, 20)])


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, code, action: 0 buys, 1 sells."""
    q = traded(spark, sf_dir).withColumn("action", ((F.col("key") * 31 + F.col("day_idx") * 17) % 11).cast("int"))
    return q.where("action IN (0, 1)").select("date", "code", "day_idx", "action")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, fiscal_year, fiscal_season, period, revenue (cents), report_date (may be null), dividend."""
    o = read(spark, sf_dir, "orders")
    g = o.groupBy((F.col("o_custkey") % 50).cast("long").alias("key"), F.year("o_orderdate").alias("fiscal_year"), F.quarter("o_orderdate").alias("fiscal_season")).agg(F.sum(F.floor(100 * F.col("o_totalprice") + 0.5)).cast("double").alias("revenue"))
    end = F.last_day(F.make_date("fiscal_year", F.col("fiscal_season") * 3, F.lit(1)))
    g = g.withColumn("report_date", F.when((F.col("key") + F.col("fiscal_season")) % 11 != 0, F.date_add(end, (10 + F.col("key") % 60).cast("int"))))
    return g.select(
        F.lpad(F.col("key").cast("string"), 6, "0").alias("code"), "key", "fiscal_year", "fiscal_season", (F.col("fiscal_year") * 100 + F.col("fiscal_season")).alias("period"),
        "revenue", "report_date", F.concat(F.lit("10派"), F.format_string("%d.%d", F.floor(F.col("key") % 40 / 10), F.col("key") % 40 % 10), F.lit("转2")).alias("dividend"),
    )


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """year, month, m0 (order totals of the month in cents), announced on the 15th of the next month."""
    o = read(spark, sf_dir, "orders")
    g = o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.sum(F.floor(100 * F.col("o_totalprice") + 0.5)).cast("double").alias("m0"))
    return g.withColumn("announced", F.date_add(F.add_months(F.make_date("year", "month", F.lit(1)), 1), 14))


_CODE = "CASE key % 4 WHEN 0 THEN '60' WHEN 1 THEN '002' WHEN 2 THEN '300' ELSE '000' END"
_BAR = """arg_min(price, ord) AS open, arg_max(price, ord) AS close, max(price) AS top, min(price) AS bottom, sum(qty) AS volume, sum(cents) AS amount"""
_BARS = """day_idx, open,
    floor(CASE WHEN day_idx % 12 = 0 THEN top ELSE top * (200 + day_idx % 4) / 200 END + 0.5) AS high,
    floor(CASE WHEN day_idx % 12 = 0 THEN bottom ELSE bottom * (200 - day_idx % 3) / 200 END + 0.5) AS low, close, volume, amount, volume / 1000 AS turnover"""
#: The same panels for the oracle, as common table expressions: name to the names it needs and its SQL.
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": ((), """SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS key, l_returnflag AS flag, floor(100 * l_extendedprice / l_quantity + 0.5) AS price, l_quantity AS qty,
      floor(100 * l_extendedprice + 0.5) AS cents, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS ord FROM lineitem"""),
    "calendar": (("lines",), "SELECT date, row_number() OVER (ORDER BY date) - 1 AS day_idx FROM (SELECT DISTINCT date FROM lines)"),
    "quotes": (("lines", "calendar"), f"""SELECT date, key, {_CODE} || lpad(key::VARCHAR, greatest(length(key::VARCHAR), 6 - length({_CODE}))::INT, '0') AS code, {_BARS}
      FROM (SELECT key, date, {_BAR} FROM lines GROUP BY ALL) JOIN calendar USING (date)"""),
    "series": (("lines", "calendar"), f"SELECT date, series_id, {_BARS} FROM (SELECT flag AS series_id, date, {_BAR} FROM lines GROUP BY ALL) JOIN calendar USING (date)"),
    "vals": ((), "SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS series_id, sum(floor(100 * o_totalprice + 0.5)) AS value FROM orders GROUP BY ALL"),
    "description": (("quotes",), """SELECT code, key, n_name AS area, 'I' || (key % 7) AS industry, first - CAST(key % 90 AS INT) AS list_date FROM (SELECT code, key, min(date) AS first FROM quotes GROUP BY ALL)
      JOIN supplier ON s_suppkey = key JOIN nation ON s_nationkey = n_nationkey"""),
    "valuation": (("quotes",), """SELECT date, code, key, day_idx, floor(1000 + abs(s_acctbal)) * close AS FREE_MRK_CAP, 2 * floor(1000 + abs(s_acctbal)) * close AS TOT_MRK_CAP, ((key + day_idx) % 50 - 5)::DOUBLE AS PE_TTM
      FROM quotes JOIN supplier ON s_suppkey = key"""),
    "flags": (("quotes",), "SELECT date, code, ((key + day_idx) % 17 = 0)::INT AS ST_FLAG, (key % 3 = 0)::INT AS HS300_FLAG FROM quotes"),
    "predictions": (("quotes",), "SELECT date, code, key, day_idx, " + ", ".join(f"(key * 7919 + day_idx * 1047 * {h}) % 10007 / 10007.0::DOUBLE AS proba_1_{h}D" for h in (2, 5, 10, 20)) + " FROM quotes"),
    "outcomes": (("quotes",), "SELECT date, code, key, day_idx, " + ", ".join(f"(lead(close, {h}) OVER w > close)::INT AS Y_{h}D" for h in (2, 5, 10, 20)) + " FROM quotes WINDOW w AS (PARTITION BY code ORDER BY date)"),
    "trades": (("quotes",), "SELECT date, code, day_idx, action FROM (SELECT *, ((key * 31 + day_idx * 17) % 11)::INT AS action FROM quotes) WHERE action IN (0, 1)"),
    "reports": ((), """SELECT lpad(key::VARCHAR, 6, '0') AS code, key, fiscal_year, fiscal_season, fiscal_year * 100 + fiscal_season AS period, revenue,
      CASE WHEN (key + fiscal_season) % 11 <> 0 THEN (last_day(make_date(fiscal_year, fiscal_season * 3, 1)) + CAST(10 + key % 60 AS INT))::DATE END AS report_date,
      '10派' || (key % 40 // 10) || '.' || (key % 40 % 10) || '转2' AS dividend
      FROM (SELECT o_custkey % 50 AS key, year(o_orderdate) AS fiscal_year, quarter(o_orderdate) AS fiscal_season, sum(floor(100 * o_totalprice + 0.5)) AS revenue FROM orders GROUP BY ALL)"""),
    "macro": ((), """SELECT *, (make_date(year, month, 1) + INTERVAL 1 MONTH + INTERVAL 14 DAY)::DATE AS announced
      FROM (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, sum(floor(100 * o_totalprice + 0.5)) AS m0 FROM orders GROUP BY ALL)"""),
}


def oracle(sql: str, *names: str) -> str:
    """sql after the named panels and what these need."""
    needed: dict[str, str] = {}

    def add(name: str) -> None:
        for n in SQL[name][0]:
            add(n)
        needed.setdefault(name, SQL[name][1])

    for n in names:
        add(n)
    ctes = ", ".join(f"{n} AS ({q})" for n, q in needed.items())
    recursive = "RECURSIVE " if sql.startswith("WITH RECURSIVE ") else ""
    rest = sql.removeprefix("WITH ").removeprefix(recursive)
    return f"WITH {recursive}{ctes} {', ' + rest if sql[:5] == 'WITH ' else sql}" if ctes else sql
