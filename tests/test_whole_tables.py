"""Registered queries read whole tables: no row filter on ids, no modulo
sampling, no row caps in the fixture views or the oracle SQL."""

import re

from shortfall.plans import fixtures as X
from shortfall.plans.oracle import oracle_sql


def _where_clauses(sql: str) -> list[str]:
    return re.findall(r"\bWHERE\b(.*?)(?=\bGROUP BY\b|\bORDER BY\b|\)\s*(?:,|SELECT|$)|$)", sql, flags=re.S)


def test_fixture_views_have_no_row_filter():
    for name, view in X.VIEWS.items():
        assert "WHERE" not in view.sql().upper(), name


def test_oracle_sql_has_no_sampling_or_caps():
    for name, sql in oracle_sql().items():
        assert not re.search(r"\bLIMIT\b|\bSAMPLE\b|TABLESAMPLE", sql, flags=re.I), name
        for clause in _where_clauses(sql):
            assert "%" not in clause, (name, clause[:120])
