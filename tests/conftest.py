from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in Path(TINY).iterdir():
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
    return c


def plain(v):
    import datetime
    import math

    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v.isoformat(" ")[:19] if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="session")
def same(duck):
    """Checks that a DataFrame and a SQL text give the same rows, in any order."""

    def check(df, sql):
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(df.columns) == sorted(names)
        want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall()), key=repr)
        got = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
        assert got == want

    return check
