"""The driver contract: entry, query catalogue and oracle keys."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"record_id", "source", "issue_type", "pct_outside", "severity"}
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60
