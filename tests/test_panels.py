"""Stored panels follow their tables and go with the session; one-hot columns have a bound."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
import time
from pathlib import Path

import pytest
from conftest import TINY

from quantloom.operators.assemble import rounded_one_hot
from quantloom.sources import panels


def test_a_table_written_anew_gets_new_panels(spark, tmp_path):
    whole = spark.read.parquet(f"{TINY}/lineitem.parquet")
    path = str(tmp_path / "lineitem.parquet")
    whole.where("l_suppkey <= 3").write.parquet(path)
    codes = lambda df: {r.key for r in df.select("key").distinct().collect()}
    few = {r.key for r in whole.where("l_suppkey <= 3").selectExpr("l_suppkey AS key").distinct().collect()}
    assert codes(panels.quotes(spark, str(tmp_path))) == few
    first = panels.quotes(spark, str(tmp_path))
    assert first.inputFiles() == panels.quotes(spark, str(tmp_path)).inputFiles()
    whole.where("l_suppkey <= 5").write.mode("overwrite").parquet(path)
    more = codes(panels.quotes(spark, str(tmp_path)))
    assert more > few
    assert panels.first_days(spark, str(tmp_path)).count() == len(more)
    assert codes(first) == few  # the old panel still serves what was built on it


def test_a_single_file_counts_as_a_table_too(spark, tmp_path):
    at = tmp_path / "lineitem.parquet"
    given = Path(TINY) / "lineitem.parquet"
    (shutil.copytree if given.is_dir() else shutil.copy)(given, at)
    before = panels.table_state(spark, str(at))
    os.utime(at, (1, 1))
    assert panels.table_state(spark, str(at)) != before


def test_stored_panels_go_with_the_session(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from quantloom.sources import panels
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
assert panels.calendar(s, {TINY!r}).count() > 0
import os
print(sum(n.startswith("calendar-") for f in os.listdir({str(tmp_path)!r}) if f.startswith("quantloom-") for n in os.listdir({str(tmp_path)!r} + "/" + f)))
s.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[1], timeout=200)
    assert out.stdout.strip().endswith("1"), out.stderr[-2000:]
    until = time.time() + 30  # the JVM ends some moments after the interpreter
    while time.time() < until and any(tmp_path.glob("quantloom-*")):
        time.sleep(0.2)
    assert not any(tmp_path.glob("quantloom-*"))


def test_one_hot_of_too_many_values_is_an_error(spark):
    df = spark.range(30).selectExpr("id / 10 AS v")
    assert len(rounded_one_hot(df, "v", 0, most=4).columns) == 5
    with pytest.raises(ValueError, match="more than 3"):
        rounded_one_hot(df, "v", 0, most=3)


def test_bars_are_summed_up_where_their_lines_are_dealt(spark):
    """One exchange, below all sums, and of the lines' own columns: a carried first or last line has them twice."""
    bars = panels._bars(panels.lines(spark, TINY, "key", "date"), ["key"], panels.calendar(spark, TINY))
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Aggregate" not in plan[plan.index("Exchange hashpartitioning"):].split("BroadcastExchange")[0]
