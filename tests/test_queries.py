"""Every query against its oracle on the smallest tables."""

from __future__ import annotations

import pytest

from conftest import TINY
from quantloom.plans.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, same, name):
    same(QUERIES[name](spark, TINY), ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    df = QUERIES[name](spark, TINY)
    assert df.columns and df.limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_does_not_need_the_language_model_part():
    import re
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "quantloom"
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert not re.search(r"quantloom\.llm|import llm", f.read_text())
