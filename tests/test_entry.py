"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as E


def test_entry_runs_flagship_query(spark):
    df = E.entry(spark)
    assert df.count() > 0
    from shortfall.operators.report import REPORT_COLUMNS
    assert df.columns == list(REPORT_COLUMNS) + ["visible", "gap_colour", "gap_ig_colour"]


def test_every_base_query_has_an_oracle():
    from shortfall.plans.catalogue import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    assert all(callable(q) for q in E.queries().values())
