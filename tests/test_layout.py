"""Assembly from bucketed parts: no exchange by the key, parts that repeat keys, keys that are null, large small parts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quantloom.operators.assemble import Part, assembled, wide_panel
from quantloom.sources.layout import in_buckets


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def panel(spark, rows: int, column: str):
    return spark.range(rows).select(F.expr("date_add(DATE '2020-01-01', CAST(id % 50 AS INT))").alias("date"), (F.col("id") % 97).cast("string").alias("code"), (F.col("id") * 3).alias(column))


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_five_parts_without_exchange(spark, no_broadcast):
    anchor = in_buckets(panel(spark, 4000, "close"), "anchor", buckets=6)
    parts = [Part(in_buckets(panel(spark, 4500 + i, f"f{i}"), f"part{i}", buckets=6), ("date", "code"), f"p{i}_") for i in range(5)]
    found = wide_panel(anchor, parts)
    assert "Exchange" not in plan_of(found)
    assert found.count() == 4000 and len(found.columns) == 8
    loose = wide_panel(panel(spark, 4000, "close"), [Part(panel(spark, 4500 + i, f"f{i}"), ("date", "code"), f"p{i}_") for i in range(5)])
    assert "Exchange" in plan_of(loose)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, loose.collect()))


def test_waves_end_the_plan(spark, no_broadcast):
    anchor = in_buckets(panel(spark, 900, "close"), "anchor", buckets=3)
    first = [Part(in_buckets(panel(spark, 900, "f"), "part", buckets=3), ("date", "code"))]
    second = [Part(in_buckets(panel(spark, 900, "g"), "part", buckets=3), ("date", "code"))]
    found = assembled(anchor, [first, second], buckets=3)
    assert "Exchange" not in plan_of(found)
    # The second wave starts at a written table, so the first wave's anchor isn't in its plan.
    assert "anchor_" not in plan_of(found) and "wave_" in plan_of(found)
    assert all(r["f"] == r["g"] for r in found.collect()) and found.count() == 900


@pytest.mark.parametrize("threshold, joins", [("10MB", "BroadcastHashJoin"), ("-1", "SortMergeJoin")])
def test_small_parts_are_broadcast_by_their_size(spark, threshold, joins):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        days = panel(spark, 50, "v").select("date", "v")
        found = wide_panel(panel(spark, 500, "close"), [Part(days, ("date",), "d_", small=True)])
        assert joins in plan_of(found) and found.count() == 500 and found.where("d_v IS NULL").count() == 0
    finally:
        spark.conf.set(name, before)


def test_repeated_null_and_absent_keys(spark):
    anchor = spark.createDataFrame([("2020-01-01", "a", 1), ("2020-01-01", None, 2), (None, "a", 3), ("2020-01-02", "z", 4)], "date STRING, code STRING, x INT")
    part = spark.createDataFrame([("2020-01-01", "a", 9), ("2020-01-01", "a", 5), ("2020-01-01", None, 7)], "date STRING, code STRING, y INT")
    found = wide_panel(in_buckets(anchor, "anchor", buckets=2), [Part(in_buckets(part, "part", buckets=2), ("date", "code"))])
    assert {r["x"]: r["y"] for r in found.collect()} == {1: 5, 2: None, 3: None, 4: None}
    assert wide_panel(in_buckets(anchor.limit(0), "anchor", buckets=2), [Part(in_buckets(part, "part", buckets=2), ("date", "code"))]).count() == 0


def test_bars_lie_by_code(spark, no_broadcast):
    """Windows by code of the stored bars need no exchange; bars have the first and last line in order, also where lines share a day."""
    from conftest import TINY
    from pyspark.sql import Window

    from quantloom.sources import panels

    q = panels.quotes(spark, TINY)
    assert "Exchange" not in plan_of(q.select("date", F.lag("close").over(Window.partitionBy("code").orderBy("date")).alias("before")))
    assert "Exchange" not in plan_of(panels.outcomes(spark, TINY))
    plain = panels._bars(panels.lines(spark, TINY), ["key"], panels.calendar(spark, TINY))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, q.select(plain.columns).collect()))
