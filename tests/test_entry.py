"""Driver contract of __spark_entry__."""

import re

import __spark_entry__ as E
from linkrec.plans.registry import ORACLE, QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_a", "user_b", "jaccard_score"]
    assert df.count() >= 0


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q) and set(ORACLE) <= set(o)
    assert len(QUERIES) >= 78 and len(ORACLE) >= 60
    for name in q:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
    for name in QUERIES:
        assert "pipeline" not in name and not re.match(r"op\d+_", name)
