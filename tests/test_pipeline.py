"""Invariants of the whole job on the sf0.001 fixture views, and the Spark
queries against their DuckDB oracle (the driver's correctness gate)."""

import hashlib
import math
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from shortfall.plans import catalogue as CAT
from shortfall.plans import fixtures as X
from shortfall.plans.job import build_stages
from shortfall.plans.oracle import oracle_sql

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def st(spark):
    return build_stages(CAT.inputs(spark, SF_SMALL), CAT.PARAMS)


def test_latest_snapshot_one_row_per_key(st):
    li = st["latest_inventory"]
    assert li.count() == li.select("location", "item").distinct().count()


def test_reconcile_preserves_quantity(spark, st):
    """A2 keeps the total of the rows that survive the secondary exclusion."""
    from shortfall.operators import reconcile as RC
    li = st["latest_inventory"]
    bad = RC.uom_inconsistent_keys(li).select("item").distinct()
    kept = RC.drop_secondary_inconsistent(li, bad, CAT.PARAMS.secondary_location)
    total_in = kept.agg(F.coalesce(F.sum("available_qty"), F.lit(0.0))).collect()[0][0]
    total_out = st["reconciled_inventory"].agg(F.sum("available_qty")).collect()[0][0]
    assert total_in == total_out


def test_left_joins_keep_every_feed_row(st):
    feed_ids = {r.row_id for r in st["feed"].select("row_id").collect()}
    assert {r.row_id for r in st["coverage"].select("row_id").distinct().collect()} == feed_ids
    assert {r.row_id for r in st["report"].select("row_id").distinct().collect()} == feed_ids


def test_report_rows_are_linear(st):
    """Each full row yields max(1, number of alternatives) report rows."""
    full = st["full"].count()
    report = st["report"].count()
    review = st["review"].count()
    assert full <= report <= full + 3 * review


def test_packaging_row_counts(spark):
    feed = X.load(spark, SF_SMALL, "fx_feed")
    parsed = CAT.q_packaging_parse(spark, SF_SMALL)
    blank = feed.filter("packaging_string IS NULL OR packaging_string = ''").count()
    assert parsed.filter("convert_to_uom = ''").count() == blank


def test_retention_split_partitions_input(spark):
    split = CAT.q_retention_split(spark, SF_SMALL)
    counts = {r.retention: r["count"] for r in split.groupBy("retention").count().collect()}
    assert sum(counts.values()) == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return "inf" if v == math.inf else "-inf" if v == -math.inf else f"{float(v):.6f}"
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = CAT.QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _digest(s_cols, s_rows) == _digest(o_cols, o_rows)


def test_every_query_has_an_oracle():
    assert set(CAT.QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", ["coverage_metrics", "inventory_freshness", "latest_arrival", "retention_split"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    """All timestamps are wall-clock (TIMESTAMP_NTZ); a non-UTC session must
    give the same rows."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = CAT.QUERIES[name](spark, SF_SMALL)
        s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = duck.execute(oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert _digest(s_cols, s_rows) == _digest(o_cols, o_rows)


@pytest.mark.parametrize("parts", [1, 13, 64])
@pytest.mark.parametrize("name", ["feed_row_id", "final_report"])
def test_partition_count_does_not_change_results(spark, duck, name, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = CAT.QUERIES[name](spark, SF_SMALL)
        s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    cur = duck.execute(oracle_sql()[name])
    assert _digest(s_cols, s_rows) == _digest([d[0] for d in cur.description], cur.fetchall())


def test_sorted_report_order(spark):
    from shortfall.operators.report import sort_report
    rep = sort_report(CAT.QUERIES["final_report"](spark, SF_SMALL)).collect()
    status = [r.match_status for r in rep]
    assert status == sorted(status)
    matched = [r.coverage_gap for r in rep if r.match_status == "Matched"]
    finite = [g for g in matched if g is not None]
    assert finite == sorted(finite, reverse=True)
    assert all(g is None for g in matched[len(finite):])


def test_freshness_from_latest_equals_history_scan(spark):
    from shortfall import sources as S
    st = CAT.stages(spark, SF_MID)
    for days in (10, 400, 4000):
        a = S.freshness_from_latest(st["latest_inventory"], CAT.PARAMS.freshness_as_of, days).collect()
        b = S.inventory_freshness(X.load(spark, SF_MID, "fx_inventory"), CAT.PARAMS.locations,
                                  CAT.PARAMS.freshness_as_of, days).collect()
        assert a == b


def test_unpinned_graph_gives_the_same_report(spark, duck):
    import dataclasses
    p = dataclasses.replace(CAT.PARAMS, pin_stages=False)
    df = build_stages(CAT.inputs(spark, SF_SMALL), p)["report"]
    cur = duck.execute(oracle_sql()["final_report"])
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(
        [d[0] for d in cur.description], cur.fetchall())


def test_null_keys(spark):
    import dataclasses
    st = CAT.stages(spark, SF_SMALL)
    lines = st["feed"].filter("vendor_item IS NULL").count()
    nulls = st["feed_with_substitutes"].filter("vendor_item IS NULL")
    assert lines > 10 and nulls.count() == lines and nulls.filter("match_status = 'Matched' OR with_sub IS NOT NULL").count() == 0
    p = dataclasses.replace(CAT.PARAMS, null_keys="match")
    matched = build_stages(CAT.inputs(spark, SF_SMALL), p)["coverage"].filter("vendor_item IS NULL AND match_status = 'Matched'")
    assert matched.count() > lines      # "match" pairs NULL keys



def test_shuffled_inputs_give_the_same_report(spark, duck):
    """Input row order and partitioning must not matter (row ids, latest
    snapshot, arrival pick and group numbering use explicit total orders)."""
    from pyspark.sql import functions as F
    data = {k: v.repartition(7, F.rand(11)) for k, v in CAT.inputs(spark, SF_SMALL).items()}
    df = build_stages(data, CAT.PARAMS)["report"]
    cur = duck.execute(oracle_sql()["final_report"])
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(
        [d[0] for d in cur.description], cur.fetchall())


def test_shuffled_arrivals_give_the_same_pick(spark, duck):
    from pyspark.sql import functions as F
    from shortfall import sources as S
    arr = X.load(spark, SF_SMALL, "fx_arrivals").repartition(5, F.rand(3))
    df = S.latest_arrival(arr, X.ARRIVALS_AS_OF, X.ARRIVALS_KEYWORD, X.ARRIVALS_PREFIX,
                          max_messages=X.ARRIVALS_MAX_MESSAGES, lookback_hours=X.ARRIVALS_LOOKBACK_HOURS,
                          fallback_folder=X.ARRIVALS_FALLBACK_FOLDER)
    cur = duck.execute(oracle_sql()["latest_arrival"])
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(
        [d[0] for d in cur.description], cur.fetchall())
