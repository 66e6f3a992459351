"""Slices of long groups: even whatever the values are, and right."""

from __future__ import annotations

from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.operators import timing
from quantloom.operators.slices import below, rank_from_top, sliced

N = 20_000


@pytest.fixture
def many_tasks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _values(kind):
    rng = np.random.default_rng(5)
    x = rng.random(N)
    if kind == "outlier":
        x[7] = 1e12
    elif kind == "third equal":
        x[rng.random(N) < 1 / 3] = 0.5
    else:
        x = np.exp(rng.normal(size=N) * 8)
    return x


@pytest.mark.parametrize("kind", ["outlier", "third equal", "heavy tail"])
def test_no_slice_holds_twice_the_median(spark, many_tasks, kind):
    rows = [("g", float(v), i) for i, v in enumerate(_values(kind))]
    df = spark.createDataFrame(rows, "g string, v double, id long").repartition(4, "id")
    sizes = [r["count"] for r in sliced(df, ["g"], [F.desc("v"), "id"]).groupBy("__slice").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * median(sizes)
    got = {r.id: r["__rank"] for r in rank_from_top(df, ["g"], "v", ["id"]).collect()}
    want = {i: k + 1 for k, (_, v, i) in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])))}
    assert got == want


def test_sums_below_a_value(spark, many_tasks):
    rng = np.random.default_rng(6)
    rows = [(g, float(v), int(n)) for g in ("a", "b") for v, n in zip(np.unique(np.round(np.exp(rng.normal(size=3000) * 5), 6)), rng.integers(0, 9, 3000), strict=False)] + [("c", 1.0, 4)]
    got = {(r.g, r.v): (r.below_n, r.all_n) for r in below(spark.createDataFrame(rows, "g string, v double, n long"), ["g"], "v", ["n"]).collect()}
    for g in ("a", "b", "c"):
        mine = sorted((v, n) for k, v, n in rows if k == g)
        up_to = np.cumsum([n for _, n in mine])
        assert [got[g, v] for v, _ in mine] == [(int(u - n), int(up_to[-1])) for u, (_, n) in zip(up_to, mine, strict=True)]


@pytest.mark.parametrize("values", [[1.0], [2.0] * 50, [1.0, 5.0], list(range(1000)), [0.0] * 700 + list(range(300)) + [1e12]])
def test_quantile_cuts_against_sorting(spark, values):
    rows = [(float(v), i % 2) for i, v in enumerate(values)]
    got = timing.quantile_cuts(timing.value_counts(spark.createDataFrame(rows, "x double, y int"), ["x"], "y"))
    x = sorted(values)
    at = [round((len(x) - 1) * q / 100, 9) for q in range(1, 101)]
    assert sorted(r.upper for r in got.collect()) == sorted({(x[int(np.floor(a))] + x[int(np.ceil(a))]) / 2 for a in at})
