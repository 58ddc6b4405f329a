"""Hot keys: one vendor item holds a third of the feed lines, one
(location, item) a third of the snapshots, one group a third of the links.
Results must still equal the oracle and stay linear in the input."""

import dataclasses

import pytest

from conftest import SF_SMALL
from shortfall.plans import catalogue as CAT
from shortfall.plans import fixtures as X
from shortfall.plans.oracle import oracle_sql
from test_pipeline import _digest, duck  # noqa: F401  (fixture)


def _replace(view, alias, expr):
    return dataclasses.replace(view, columns=tuple((expr if a == alias else e, a) for e, a in view.columns))


def _hot(view, alias, key, hot_value):
    original = dict((a, e) for e, a in view.columns)[alias]
    return _replace(view, alias, f"CASE WHEN {key} % 3 = 0 THEN {hot_value} ELSE {original} END")


@pytest.fixture()
def skewed(monkeypatch):
    views = dict(X.VIEWS)
    views["fx_feed"] = _hot(views["fx_feed"], "vendor_item", "o_orderkey", "'V7'")
    inv = _hot(views["fx_inventory"], "item", "l_orderkey", "'I7'")
    inv = _hot(inv, "vendor_item", "l_orderkey", "'V7'")
    views["fx_inventory"] = _hot(inv, "location", "l_orderkey", "'A'")
    views["fx_item_link"] = _hot(views["fx_item_link"], "item_group", "p_partkey", "'G0'")
    monkeypatch.setattr(X, "VIEWS", views)
    return views


@pytest.mark.parametrize("name", ["latest_inventory", "reconciled_inventory", "coverage_metrics",
                                  "group_coverage", "uom_alternatives", "final_report"])
def test_hot_keys_match_oracle(spark, duck, skewed, name):  # noqa: F811
    df = CAT.QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    assert _digest(s_cols, s_rows) == _digest([d[0] for d in cur.description], cur.fetchall())


def test_hot_keys_stay_linear(spark, skewed):
    st = CAT.stages(spark, SF_SMALL)
    feed = st["feed"].count()
    hot = st["feed"].filter("vendor_item = 'V7'").count()
    assert hot * 3 >= feed * 0.9
    full = st["full"].count()
    report = st["report"].count()
    # each feed line meets at most a few inventory rows and links; no line is
    # paired with the other lines of its hot key
    assert full <= 4 * feed
    assert report <= 4 * full
