"""The random search repeats itself whatever the partitioning, and finds what the labels hold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from conftest import TINY
from quantloom.operators import evaluate as ev
from quantloom.plans.catalog import QUERIES


def test_best_setting_under_any_partitioning(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=3000) > 0).astype(int)
    rows = [(i, *map(float, v), int(t) if i % 50 else None) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int")
    settings = ev.drawn_settings(4, 3, depths=(1, 4))
    assert settings == ev.drawn_settings(4, 3, depths=(1, 4)) and len({s["stepSize"] for s in settings}) == 4
    one, many = (ev.random_search(df.repartition(n), ["a", "b", "c"], "y", ["id"], settings=settings, rounds=3, parts=3).collect() for n in (1, 17))
    assert one == many and [r.auc for r in one] == sorted((r.auc for r in one), reverse=True)
    # A stump can't see a product of two features.
    assert one[0].depth > 1 and one[0].auc > 0.8


def test_fits_see_cells_however_many_rows_there_are(spark):
    """Cells hold all rows with a label, bins about as many each, whatever the offset or outliers, and copies of the rows make no more cells than blocks of them."""
    rng = np.random.default_rng(4)
    x = np.stack([1e6 + rng.normal(size=2000), rng.standard_cauchy(2000), rng.integers(0, 3, 2000)]).T
    x[1, 1], x[5, 1] = np.nan, -1e12
    rows = [(i, *(None if i == 6 else v for v in map(float, r)), int(i % 3 == 0) if i % 100 else None) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int")
    table = lambda t: [(r.y, tuple(r.features), r.fold, r.weight) for r in ev.cells(t, ["a", "b", "c"], "y", ["id"], seed=1, fold=F.lit(0), parts=3).collect()]
    one = table(df)
    assert one == table(df.repartition(7)) and sum(r[-1] for r in one) == 1980
    for k, sizes in ((0, 31), (1, 31), (2, 3)):
        found = {}
        for _, place, _, n in one:
            found[place[k]] = found.get(place[k], 0) + n
        assert found.pop(0.0) == (2 if k == 1 else 1) and len(found) == sizes
        assert k == 2 or max(found.values()) <= 1980 / 31 + 25
    copies = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).withColumn("id", F.col("copy") * 10000 + F.col("id"))
    many = table(copies)
    assert sum(r[-1] for r in many) == 40 * 1980 and len({r[:2] for r in many}) <= 1980 and len(many) <= 8 * 1980


def test_nothing_known_and_nothing_to_tell_apart(spark):
    rows = [(i, None, 1.0, float("inf") if i % 2 else 2.0, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int")
    found = ev.random_search(df, ["a", "b", "c"], "y", ["id"], settings=ev.drawn_settings(1, 3, depths=(1, 2)), rounds=2, parts=2).collect()
    assert len(found) == 1 and 0 <= found[0].auc <= 1


def test_the_query_searches_the_whole_grid(spark):
    found = QUERIES["i2_search"](spark, TINY).collect()
    assert [r.setting for r in found] == list(range(8)) and all(0 <= r.auc <= 1 for r in found)
