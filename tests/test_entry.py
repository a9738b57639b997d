"""The driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as entry_mod


def test_entry_runs_and_has_rows(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "eventKey" in df.columns


def test_every_query_of_the_library_has_an_oracle():
    from eventweave.plans.catalog import oracle_sql, queries

    assert set(queries()) == set(oracle_sql()) and len(queries()) >= 60
    assert set(queries()) <= set(entry_mod.queries()) and set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
