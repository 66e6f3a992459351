"""Moves of the days before a code trades again give the same as a matrix of all days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from quantloom.operators import portfolio as pf


def test_moves_equal_those_of_the_price_matrix(spark):
    day = lambda i: date(2020, 1, 1) + timedelta(days=i)
    calendar = spark.createDataFrame([(day(i), i) for i in range(12)], "date date, day_idx long")
    opens = {"a": {0: 10.0, 1: 11.0, 5: 9.0, 11: 8.0}, "b": {3: 0.0, 4: 7.0, 6: None, 9: 14.0}, "c": {2: 5.0}, "d": {0: None, 2: 4.0, 3: 6.0}}
    quotes = spark.createDataFrame([(day(i), c, i, v) for c, days in opens.items() for i, v in days.items()], "date date, code string, day_idx long, open double")
    full = pf.price_matrix(quotes, calendar, ["open"])
    nxt = F.lead("open").over(Window.partitionBy("code").orderBy("date"))
    want = full.select("date", "code", F.coalesce(F.try_divide(nxt, F.col("open")) - 1, F.lit(0.0)).alias("move")).where("move <> 0")
    moves = pf.moves_between(quotes, calendar)
    assert sorted(map(tuple, moves.where("move <> 0").collect())) == sorted(map(tuple, want.collect()))
    assert moves.count() <= quotes.count()
