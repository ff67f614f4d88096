"""Driver contract: entry runs on sf0.001 with a stable schema; every SQL
twin belongs to a registered query."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    a = entry.entry(spark)
    rows = a.collect()
    assert len(rows) > 0
    assert entry.entry(spark).schema == a.schema


def test_registry_consistency():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 49 and len(o) >= 38
    for name in q:
        assert callable(q[name]), name
