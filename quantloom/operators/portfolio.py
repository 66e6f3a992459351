"""Screening and portfolio evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.sources.io import kept


def yesterdays(scores: DataFrame, calendar: DataFrame, columns: list[str]) -> DataFrame:
    """On each trade day the scores of the trade day before."""
    days = F.broadcast(calendar.select(F.col("date").alias("__today"), (F.col("day_idx") - 1).alias("__before")))
    return scores.join(days, F.col("day_idx") == F.col("__before")).select(F.col("__today").alias("date"), "code", *columns)


def candidates(day: DataFrame, quotes: DataFrame, flags: DataFrame, listing: DataFrame, *, score: str, threshold: float | None = None, members: DataFrame | None = None, least_days: int = 60) -> DataFrame:
    """Scores of codes that trade today, don't open limit-up, aren't under special treatment and are listed long enough.

    quotes holds LIMIT_UP; members, if given, holds (date, code). A null flag doesn't pass.
    """
    out = day.join(quotes.where("LIMIT_UP = 0").select("date", "code"), ["date", "code"], "left_semi").join(flags.where("ST_FLAG = 0").select("date", "code"), ["date", "code"], "left_semi")
    out = out.join(listing.select("code", "list_date"), "code").where(F.datediff("date", "list_date") > least_days).drop("list_date")
    if members is not None:
        out = out.join(members.select("date", "code"), ["date", "code"], "left_semi")
    return out if threshold is None else out.where(F.col(score) > threshold)


def top_k(df: DataFrame, score: str, k: int) -> DataFrame:
    """The k best codes of each date, equal scores by code."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("date").orderBy(F.desc(score), "code"))).where(F.col("rank") <= k)


def price_matrix(quotes: DataFrame, calendar: DataFrame, columns: list[str]) -> DataFrame:
    """Every code on every trade day since its first, prices carried forward, with whether it traded."""
    first = quotes.groupBy("code").agg(F.min("date").alias("__first"))
    spine = first.crossJoin(F.broadcast(calendar.select("date", "day_idx"))).where("date >= __first").drop("__first")
    w = Window.partitionBy("code").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    out = spine.join(quotes.select("date", "code", *columns, F.lit(True).alias("__t")), ["date", "code"], "left")
    return out.withColumns({"tradable": F.coalesce("__t", F.lit(False)), **{c: F.last(c, ignorenulls=True).over(w) for c in columns}}).drop("__t")


def layers(df: DataFrame, score: str, n: int, every: int) -> DataFrame:
    """On each rebalance day (day_idx divisible by `every`) the layer 0..n-1 of each candidate by rank, and its equal weight.

    Layer k holds the ranks [int(size * k / n), int(size * (k + 1) / n)).
    """
    day = Window.partitionBy("date")
    ranked = df.where(F.col("day_idx") % every == 0).withColumn("__r", F.row_number().over(day.orderBy(F.desc(score), "code")) - 1).withColumn("__n", F.count("*").over(day))
    layer = F.lit(0)
    for k in range(1, n):
        layer = layer + (F.col("__r") >= F.floor(F.col("__n") * k / n)).cast("int")
    out = ranked.withColumn("layer", layer)
    return out.withColumn("weight", 1.0 / F.count("*").over(Window.partitionBy("date", "layer"))).drop("__r", "__n")


def after_closing(days: DataFrame, blocked: DataFrame, every: int) -> DataFrame:
    """Rebalance days when a new basket is only bought once the old one is wholly sold.

    days: day_idx of all trade days; blocked: day_idx of days on which something can't be sold. A basket is due every
    `every` days; a sale that falls on blocked days waits for the first day after them, and the next basket is bought
    then. Returns (due_idx, day_idx): each due day and the day on which its basket is really bought; due days that wait
    for the same day become one, the first.
    """
    due = days.where(F.col("day_idx") % every == 0).select(F.col("day_idx").alias("due_idx"))
    free = days.join(blocked.select("day_idx").distinct(), "day_idx", "left_anti")
    # The first free day from each day on, by one pass over the calendar backwards.
    w = Window.orderBy(F.desc("day_idx")).rowsBetween(Window.unboundedPreceding, 0)
    marked = days.select("day_idx").join(free.select("day_idx", F.col("day_idx").alias("__free")), "day_idx", "left")
    first = marked.select(F.col("day_idx").alias("due_idx"), F.min("__free").over(w).alias("day_idx"))
    bought = due.join(first, "due_idx").where("day_idx IS NOT NULL")
    return bought.groupBy("day_idx").agg(F.min("due_idx").alias("due_idx")).select("due_idx", "day_idx")


def first_from(df: DataFrame, days: DataFrame, by: list[str], at: str, day: str, name: str) -> DataFrame:
    """df with the first of its by's days (by, day) that isn't before its column at; null if there is none. One window, no range join."""
    rows = df.withColumn("__asks", F.lit(True)).unionByName(days.select(*by, F.col(day).alias(at), F.col(day).alias("__day")), allowMissingColumns=True)
    later = Window.partitionBy(*by).orderBy(F.desc(at)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.min("__day").over(later)).where("__asks").drop("__asks", "__day")


def chained(links: DataFrame, by: list[str], here: str, there: str) -> DataFrame:
    """(by, here) of each by's first link and of all that it leads to, link after link.

    links hold one row for each by and here, with a later there or null. Pointers are doubled, so a chain takes as many
    rounds of joins as its length has binary digits.
    """
    seen = kept(links.groupBy(*by).agg(F.min(here).alias(here)), "seen")
    jump = kept(links.where(F.col(there).isNotNull()).select(*by, here, there), "jump")
    while True:
        more = kept(seen.join(jump, [*by, here]).select(*by, F.col(there).alias(here)), "seen")
        if not more.limit(1).count():
            return seen
        seen = seen.unionByName(more)
        then = jump.select(*by, F.col(here).alias(there), F.col(there).alias("__then"))
        jump = kept(jump.join(then, [*by, there]).select(*by, here, F.col("__then").alias(there)), "jump")


def waiting_baskets(baskets: DataFrame, sellable: DataFrame, every: int, by: tuple[str, ...] = ("layer",)) -> DataFrame:
    """The baskets that are really bought when a new one has to wait until the old one is wholly sold.

    baskets: (by, day_idx, code, weight), the basket that each day would buy; sellable: (code, day_idx) on which a code can
    be sold. A code is due `every` days after it was bought and sold on its first such day from then on; on the last of
    a basket's sales, or the first day after it that has a basket, the next one is bought. Each by begins with its
    first basket. Returns the codes of these baskets with sold_idx, null if a code can't be sold any more; such a
    basket is the last of its by.
    """
    due = first_from(baskets.withColumn("__due", F.col("day_idx") + every), sellable, ["code"], "__due", "day_idx", "sold_idx").drop("__due")
    due = kept(due, "due")
    free = due.groupBy(*by, "day_idx").agg(F.when(F.count("sold_idx") == F.count("*"), F.max("sold_idx")).alias("__free"))
    links = first_from(free.where("__free IS NOT NULL"), free, list(by), "__free", "day_idx", "next_idx").select(*by, "day_idx", "next_idx")
    ends = free.where("__free IS NULL").select(*by, "day_idx", F.lit(None).cast("long").alias("next_idx"))
    return due.join(chained(links.unionByName(ends), list(by), "day_idx", "next_idx"), [*by, "day_idx"], "left_semi")


def held_until(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Each code of a basket on the days from its purchase to the day before its sale, or to the last day; bought marks the first."""
    days = calendar.select(F.col("date").alias("__d"), F.col("day_idx").alias("__i"))
    end = F.broadcast(calendar.agg(F.max("day_idx").alias("__end")))
    spread = df.drop("date").join(end, F.lit(True)).withColumn("__i", F.explode(F.sequence(F.col("day_idx"), F.coalesce(F.col("sold_idx") - 1, F.col("__end")))))
    return spread.join(F.broadcast(days), "__i").select(F.col("__d").alias("date"), "code", "layer", "weight", (F.col("__i") == F.col("day_idx")).alias("bought"))


def held_days(df: DataFrame, calendar: DataFrame, every: int) -> DataFrame:
    """The basket on each day that it is held, from its rebalance day on; bought marks the first."""
    days = calendar.select(F.col("date").alias("__d"), F.col("day_idx").alias("__i"))
    spread = df.withColumn("__i", F.explode(F.sequence(F.col("day_idx"), F.col("day_idx") + every - 1))).drop("date")
    return spread.join(F.broadcast(days), "__i").select(F.col("__d").alias("date"), "code", "layer", "weight", (F.col("__i") == F.col("day_idx")).alias("bought"))


def moves_between(quotes: DataFrame, calendar: DataFrame) -> DataFrame:
    """Date, code, move: the return from a day's open to the next day's, with prices carried forward as in J4.

    A carried price only moves on the day before the code trades again, so there is a row for these days alone; on all others the move
    is 0. Nothing is spread over all days of a code.
    """
    w = Window.partitionBy("code").orderBy("date")
    moved = quotes.where("open IS NOT NULL").select("code", (F.col("day_idx") - 1).alias("__i"), (F.try_divide(F.col("open"), F.lag("open").over(w)) - 1).alias("move"))
    days = F.broadcast(calendar.select("date", F.col("day_idx").alias("__i")))
    return moved.where("move IS NOT NULL").join(days, "__i").select("date", "code", "move")


def portfolio_returns(held: DataFrame, moves: DataFrame, by: list[str], *, commission: float = 0.0) -> DataFrame:
    """Per strategy and date the weighted sum of next-open returns (moves: date, code, move; 0 where there is none), less commission on what is bought."""
    j = held.join(moves, ["date", "code"], "left")
    cost = F.when(F.col("bought"), commission * F.col("weight")).otherwise(0.0)
    return j.groupBy(*by, "date").agg(F.sum(F.coalesce(F.col("weight") * F.col("move"), F.lit(0.0)) - cost).alias("ret"))


def replayed(orders: DataFrame, by: list[str]) -> DataFrame:
    """Positions (start_date, end_date; null while open) from orders: action 0 buys unless held, 1 sells if held.

    In order of dates the first buy after a sell opens and the first sell after a buy closes; of several orders on one
    day the buy comes first. Orders are filled on the next trade day, which the columns fill_date and fill_idx state.
    """
    w = Window.partitionBy(*by).orderBy("date", "action")
    turns = orders.withColumn("__p", F.lag("action").over(w)).where("(action = 0 AND (__p IS NULL OR __p = 1)) OR (action = 1 AND __p = 0)").drop("__p")
    end = lambda c: F.lead(c).over(w)
    return turns.withColumns({"end_date": end("fill_date"), "end_idx": end("fill_idx")}).where("action = 0").select(*by, F.col("fill_date").alias("start_date"), F.col("fill_idx").alias("start_idx"), "end_date", "end_idx")


def over_weight(positions: DataFrame, calendar: DataFrame, by: list[str], max_positions: int) -> DataFrame:
    """Days on which the weights of 1 / max_positions add up to more than 1.

    An opening counts 1 and a closing -1; their running sum holds from one day with such events to the day before the next.
    """
    real = positions.where("start_idx IS NOT NULL AND (end_idx IS NULL OR end_idx > start_idx)")
    told = F.array(F.struct(F.col("start_idx").cast("long").alias("day_idx"), F.lit(1).alias("n")), F.struct(F.col("end_idx").cast("long").alias("day_idx"), F.lit(-1).alias("n")))
    events = real.select(*by, F.inline(told)).where("day_idx IS NOT NULL").groupBy(*by, "day_idx").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by).orderBy("day_idx")
    last = calendar.agg(F.max("day_idx")).scalar()
    until = F.coalesce(F.lead("day_idx").over(w) - 1, last.cast("long"))
    held = events.select(*by, "day_idx", F.sum("n").over(w).alias("__held"), until.alias("__until")).where((F.col("__held") > max_positions) & (F.col("__until") >= F.col("day_idx")))
    each = held.select(*by, "__held", F.explode(F.sequence("day_idx", "__until")).alias("day_idx"))
    return each.join(F.broadcast(calendar.select("date", "day_idx")), "day_idx").select(*by, "date", (F.col("__held") / max_positions).alias("weight"))


def holding_days(positions: DataFrame, by: list[str]) -> DataFrame:
    """Mean trade days of closed positions."""
    out = positions.where("end_idx IS NOT NULL")
    mean = F.avg(F.col("end_idx") - F.col("start_idx")).alias("holding_days")
    return out.groupBy(*by).agg(mean) if by else out.agg(mean)


def performance(returns: DataFrame, by: list[str], *, yearly: bool = False, relative: bool = True, days: int = 252) -> DataFrame:
    """Annual mean and deviation, Sharpe ratio, largest drawdown and final return of daily returns.

    The deviation is a sample's for the total and a population's per year; the drawdown is relative to the peak or, if
    not relative, the plain difference.
    """
    keys = [*by, "year"] if yearly else by
    df = returns.withColumn("year", F.year("date")) if yearly else returns
    w = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    path = df.withColumn("__v", F.product(1 + F.col("ret")).over(w)).withColumn("__peak", F.max("__v").over(w))
    gap = F.col("__v") / F.col("__peak") - 1 if relative else F.col("__v") - F.col("__peak")
    dev = F.stddev_pop("ret") if yearly else F.stddev_samp("ret")
    return path.groupBy(*keys).agg(
        (F.avg("ret") * days).alias("annual_return"), (dev * days**0.5).alias("annual_std"), F.try_divide(F.avg("ret") * days, dev * days**0.5).alias("sharpe"),
        F.min(gap).alias("max_drawdown"), (F.max_by("__v", "date") - 1).alias("cumulative"),
    )


def trade_list(scores: DataFrame, held: DataFrame, score: str, *, buys: int = 20, most_days: int = 20) -> DataFrame:
    """The best names to buy; names held too long or below 0.5 to sell, unless they are to be bought. scores holds one date."""
    best = scores.withColumn("__r", F.row_number().over(Window.orderBy(F.desc(score), "code"))).where(F.col("__r") <= buys).select("code")
    tired = held.join(scores.select("code", score), "code", "left").where((F.col("holding_period") >= most_days) | (F.col(score) < 0.5)).select("code").distinct()
    return best.withColumn("side", F.lit("buy")).unionByName(tired.join(best, "code", "left_anti").withColumn("side", F.lit("sell")))


def score_history(scores: DataFrame, columns: list[str], days: int = 10) -> DataFrame:
    """Per code the rows of its last days, oldest first, as an array of structs."""
    last = F.row_number().over(Window.partitionBy("code").orderBy(F.desc("date")))
    return scores.withColumn("__r", last).where(F.col("__r") <= days).groupBy("code").agg(F.sort_array(F.collect_list(F.struct("date", *columns))).alias("history"))


def sized_orders(buys: DataFrame, cash: float, names: int, commission: float = 0.001, lot: int = 100) -> DataFrame:
    """Equal cash per name, whole lots, with cost and commission; price and cash in one unit."""
    volume = F.floor(F.lit(cash / names) / (F.col("price") * (1 + commission)) / lot) * lot
    return buys.withColumn("volume", volume).withColumn("cost", F.col("volume") * F.col("price")).withColumn("commission", F.col("cost") * commission)


def closed_records(sells: DataFrame, positions: DataFrame, opening: float, commission: float = 0.001, account: str = "account") -> DataFrame:
    """Revenue, commission, PnL and running balance of closed positions, per account in order of end date and code.

    positions names each position's account; a balance runs within its account, so accounts are dealt to tasks.
    """
    j = sells.join(positions, "code").withColumn("revenue", F.col("volume") * F.col("close_price"))
    j = j.withColumn("commission", F.col("revenue") * commission).withColumn("PnL", F.col("revenue") - F.col("commission") - F.col("cost"))
    w = Window.partitionBy(account).orderBy("end_date", "code").rowsBetween(Window.unboundedPreceding, 0)
    return j.withColumn("balance", opening + F.sum(F.col("revenue") - F.col("commission")).over(w))


def marked_to_market(positions: DataFrame, prices: DataFrame, calendar: DataFrame, today) -> DataFrame:
    """Trade days held, today's included, and floating profit at today's close; positions that start later are left out.

    The trade days up to each day are a running count over the calendar and the days on which positions start.
    """
    now = F.lit(today).cast("date")
    starts = positions.select(F.col("start_date").alias("__d"), F.lit(0).alias("__n")).distinct()
    spine = calendar.where(F.col("date") <= now).select(F.col("date").alias("__d"), F.lit(1).alias("__n")).unionByName(starts).groupBy("__d").agg(F.max("__n").alias("__n"))
    up_to = Window.orderBy(F.desc("__d")).rowsBetween(Window.unboundedPreceding, 0)
    counted = spine.select(F.col("__d").alias("start_date"), F.sum("__n").over(up_to).alias("holding_period"))
    held = positions.join(F.broadcast(counted), "start_date").where("holding_period > 0").select(*positions.columns, "holding_period")
    current = prices.where(F.col("date") == now).select("code", F.col("close").alias("current_price"))
    return held.join(current, "code", "left").withColumn("floating_PnL", (F.col("current_price") - F.col("open_price")) * F.col("volume"))


def performance_rows(values: DataFrame, by: list[str], days: int = 252) -> DataFrame:
    """Per day the daily and annualised return, annualised deviation, largest drawdown so far and duration in days."""
    w = Window.partitionBy(*by).orderBy("date")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    out = values.withColumns({"daily_return": F.try_divide(F.col("market_value"), F.lag("market_value").over(w)) - 1, "duration": F.row_number().over(w) - 1})
    out = out.withColumn("__gap", F.col("market_value") / F.max("market_value").over(so_far) - 1)
    total = F.col("market_value") / F.first("market_value").over(so_far)
    return out.withColumns({
        "annualized_return": F.when(F.col("duration") > 0, F.pow(total, F.lit(float(days)) / F.col("duration")) - 1),
        "annualized_std": F.stddev_samp("daily_return").over(so_far) * days**0.5, "max_drawdown": F.min("__gap").over(so_far),
    }).drop("__gap")


def reviewed(picks: DataFrame, prices: DataFrame, indexes: dict[str, DataFrame]) -> DataFrame:
    """Return from the pick day's open to the close of the prices' last day, and what is left over each index's return of the same days."""
    now = F.broadcast(prices.agg(F.max("date").alias("__now")))
    opened = prices.select("date", "code", F.col("open").alias("__o"))
    closed = prices.join(now, F.col("date") == F.col("__now")).select("code", F.col("close").alias("__c"))
    out = picks.join(opened, ["date", "code"]).join(closed, "code").withColumn("ret", F.try_divide(F.col("__c"), F.col("__o")) - 1).drop("__o", "__c")
    for name, index in indexes.items():
        end = index.join(now, F.col("date") == F.col("__now")).agg(F.max("close").alias("__e"))
        move = F.broadcast(index.select("date", F.col("open").alias("__i")).crossJoin(F.broadcast(end)).select("date", (F.try_divide(F.col("__e"), F.col("__i")) - 1).alias("__m")))
        out = out.join(move, "date", "left").withColumn(f"alpha_{name}", F.col("ret") - F.col("__m")).drop("__m")
    return out


def rounded(df: DataFrame, keys: list[str], columns: list[str], digits: int = 6) -> DataFrame:
    as_column: dict[str, Column] = {c: F.round(c, digits) for c in columns}
    return df.select(*keys, *[v.alias(k) for k, v in as_column.items()])
