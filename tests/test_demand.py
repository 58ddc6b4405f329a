"""Reduction to what the feed reaches: the report stays the same, fewer rows enter the aggregates."""

from dataclasses import replace

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shortfall.operators import demand as D
from shortfall.plans import catalogue as CAT
from shortfall.plans.job import build_stages


def test_filter_holds_every_item_and_few_others(spark):
    items = spark.range(300).select(F.concat(F.lit("I"), "id").alias("item"))
    words = D.bloom_filter(items, bits=1 << 13)
    assert words.count() == 1 and len(words.first()["words"]) == 128
    rows = spark.range(3000).select(F.concat(F.lit("I"), "id").alias("item")).unionByName(spark.createDataFrame([(None,)], "item string"))
    kept = {r["item"] for r in D.keep_needed(rows, words, bits=1 << 13).collect()}
    assert kept >= {f"I{i}" for i in range(300)} | {None} and len(kept) < 500
    assert D.keep_needed(rows, D.bloom_filter(items.limit(0))).collect() == [(None,)]
    numbers = spark.range(5).select(F.col("id").alias("item"))                   # keys of another type meet as text
    assert D.keep_needed(numbers, D.bloom_filter(numbers.select(F.col("item").cast("string")))).count() == 5


def test_two_hops(spark):
    feed = spark.createDataFrame([("V1",), (None,), ("V9",)], "vendor_item string")
    inventory = spark.createDataFrame([("V1", "A"), ("V2", "B"), ("V1", None), (None, "C")], "vendor_item string, item string")
    links = spark.createDataFrame([("A", "X"), ("A", None), ("X", "Y"), ("B", "Z")], "item string, replace_item string")
    assert sorted(r["item"] for r in D.needed_items(feed, inventory, links).collect()) == ["A", "X"]


def test_report_of_a_small_feed_is_unchanged_and_fewer_rows_are_aggregated(spark):
    inputs = CAT.inputs(spark, SF_SMALL)
    latest = CAT.stages(spark, SF_SMALL)["latest_inventory"]
    some = [r["vendor_item"] for r in latest.where("vendor_item IS NOT NULL").select("vendor_item").distinct().orderBy("vendor_item").limit(4).collect()]
    inputs["feed"] = inputs["feed"].where(F.col("vendor_item").isin(some) | F.col("vendor_item").isNull())
    reduced, whole = build_stages(inputs, CAT.PARAMS), build_stages(inputs, replace(CAT.PARAMS, reduce_to_feed=False))
    left, right = reduced["report"], whole["report"]
    assert left.columns == right.columns and left.count() == right.count() > 0
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    words = reduced["feed_filter"]
    assert not any("getbit" in df._jdf.queryExecution().executedPlan().toString() for df in (left, reduced["demand_usage"]))
    for rows in (reduced["latest_inventory"], inputs["usage"]):                  # what enters A2 and A3
        assert 10 * D.keep_needed(rows, words).count() < rows.count()
    assert reduced["reconciled_uom_inconsistency"].count() == whole["reconciled_uom_inconsistency"].count()


def test_transactions_are_filtered_below_the_partial_aggregate(spark):
    words, usage, p = D.bloom_filter(spark.range(3).select(F.col("id").alias("item"))), CAT.inputs(spark, SF_SMALL)["usage"], CAT.PARAMS
    lines = CAT.S.avg_daily_issue(D.keep_needed(usage, words), p.locations, p.usage_as_of)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "Filter" in line and "getbit" in line)
    assert any("partial_sum(qty" in line for line in lines[:at]) and not any("Exchange" in line for line in lines[at:at + 3])


def test_replaced_stages_are_taken_as_they_are(spark):
    st = CAT.stages(spark, SF_SMALL)
    assert st._reducing
    st.set("substitutes", st["substitutes"].limit(0))
    assert not st._reducing and st["full"].where("replace_item IS NOT NULL").isEmpty()
