"""Physical-plan invariants that carry the scale design (checked on the
initial adaptive plan, before execution)."""

import re

import pytest

from conftest import SF_SMALL
from shortfall.plans import catalogue as CAT


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(CAT.QUERIES))
def test_no_cartesian_products_or_python(spark, name):
    p = plan(CAT.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_only_nested_loop_join_is_the_one_row_stamp(spark):
    p = plan(CAT.QUERIES["final_report"](spark, SF_SMALL))
    assert p.count("BroadcastNestedLoopJoin") == 1
    assert "IdentityBroadcastMode" in p


def test_top_n_is_limited_before_the_shuffle(spark):
    p = plan(CAT.QUERIES["latest_arrival"](spark, SF_SMALL))
    lines = p.splitlines()
    limits = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l]
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(feed" in l)
    assert any(i > exchange for i in limits), "partial group limit must sit below (before) the exchange"


def test_latest_snapshot_is_limited_before_the_shuffle(spark):
    lines = plan(CAT.QUERIES["latest_inventory"](spark, SF_SMALL)).splitlines()
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(location" in l)
    assert any("WindowGroupLimit" in l and "Partial" in l for l in lines[exchange:])


def test_filters_reach_the_scan(spark):
    p = plan(CAT.QUERIES["avg_daily_issue"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", p)
    p = plan(CAT.QUERIES["retention_purge"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[Or\(GreaterThanOrEqual\(o_orderdate", p)


def test_scans_read_only_needed_columns(spark):
    p = plan(CAT.QUERIES["retention_purge"](spark, SF_SMALL))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"o_orderkey", "o_orderdate", "o_orderstatus"}


def test_row_id_range_key_is_narrow(spark):
    p = CAT.prepare_feed(CAT.X.load(spark, SF_SMALL, "fx_feed"), CAT.PARAMS)
    assert p.columns[-1] == "row_id"
    from shortfall.operators import ordinal
    seen = []
    keep, ordinal.pin = ordinal.pin, lambda df, name, folder=None: seen.append(plan(df)) or keep(df, name, folder)
    try:
        CAT.prepare_feed(CAT.X.load(spark, SF_SMALL, "fx_feed"), CAT.PARAMS)
    finally:
        ordinal.pin = keep
    keys = re.search(r"Exchange rangepartitioning\((.*?), \d+\)", seen[0]).group(1)
    assert keys.count(" ASC") == 2


def test_rows_that_cannot_match_skip_the_alternative_join(spark):
    p = plan(CAT.QUERIES["final_report"](spark, SF_SMALL))
    assert "Union" in p


def feed_wide_exchanges(df) -> int:
    """Exchanges that carry feed rows, by the columns they take in."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    blocks = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    return sum("row_id#" in b for b in blocks)


@pytest.mark.parametrize("stage,count", [("full", 1), ("feed_with_substitutes", 1), ("report", 1)])
def test_the_feed_moves_once(spark, stage, count):
    st = CAT.stages(spark, SF_SMALL)
    assert feed_wide_exchanges(st[stage]) == count
    from shortfall.operators import report as RP
    if stage == "report":
        assert feed_wide_exchanges(RP.sort_report(st[stage])) == 2                # and once to be sorted
    assert not {"full", "feed_with_substitutes"} & set(st.PINNED)


def test_item_side_rows_stay_bounded_and_complete(spark):
    from pyspark.sql import functions as F
    from shortfall.operators import itemside as IS
    rows = spark.range(1000).select(F.when(F.col("id") < 900, "V1").otherwise(F.concat(F.lit("V"), F.col("id"))).alias("vendor_item"), F.col("id").alias("item"))
    nested = IS.nest(rows, entries=50)
    assert nested.where("vendor_item = 'V1'").count() > 10 and nested.agg(F.max(F.size("entries"))).first()[0] < 100
    assert nested.select("vendor_item", F.explode("entries.item").alias("item")).exceptAll(rows).isEmpty() and nested.agg(F.sum(F.size("entries"))).first()[0] == 1000


def test_packaging_is_searched_once_for_each_part(spark):
    from shortfall.operators import uom as U
    df = spark.createDataFrame([("V1", "2 EA/BX 3 BX/CS")], "vendor_item string, packaging_string string")
    optimized = U.parse_packaging(df)._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= optimized.count("regexp_extract_all(") <= 3


def test_days_are_read_from_text_ahead_of_the_join(spark):
    st = CAT.stages(spark, SF_SMALL)
    assert "linked" in st.PINNED and "demand_reconciled" in st.PINNED
    p = plan(st["uom_alternatives"])
    assert "timestampdiff" in p and p.index("timestampdiff") > p.index("Join")          # below the join
