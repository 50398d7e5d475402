"""The driver contract."""

import __spark_entry__ as entry_module


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["part_id", "commit_offset", "deferred_count"]
    assert df.count() == 4


def test_every_query_has_an_oracle():
    assert set(entry_module.ORACLES) == set(entry_module.QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
