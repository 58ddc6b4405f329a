"""The item side of the report, joined to the feed once.

Everything that a feed line gets from its vendor item -- inventory rows (J9), substitutes (J10), group metrics (J13) and
alternative units (J20) -- depends on the vendor item alone. It is put together on the item tables first and nested: one
row per vendor item with an array of entries (an inventory row with one of its substitutes, the metrics of that link's group and the
alternatives of its unit). The feed then moves in a single exchange, and lines are unfolded behind the join.

A vendor item with very many entries has several nested rows of at most about ``ENTRIES`` each, so no
row grows with the data. Feed lines without a vendor item match nothing; they are dealt over many tasks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortfall.operators.coverage import coverage_metrics, days_to_recover, type_feed_columns
from shortfall.operators.enrich import left_join_on
from shortfall.operators.groups import group_gap, group_quantities
from shortfall.operators.uom import ALTERNATIVE_COLUMNS, UOM_KEY, alternative_table

ENTRIES = 512
NULL_TASKS = 1024
GROUP_METRICS = ("available_qty_ig", "avg_daily_issue_ig", "dioh_ig")


def spread_nulls(key: str, *by: str) -> Column:
    """The key, or for NULL one of ``NULL_TASKS`` values by the hash of the columns ``by``: as a join column beside the
    key itself, it keeps rows that match nothing from meeting in one task."""
    other = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*by), F.lit(NULL_TASKS)).cast("string"))
    return F.coalesce(F.col(key).cast("string"), other)


def feed_items(feed: DataFrame, enriched: DataFrame) -> DataFrame:
    """Enriched inventory rows of vendor items that the feed names."""
    keys = feed.select("vendor_item").where("vendor_item IS NOT NULL").distinct()
    return enriched.join(keys, "vendor_item", "left_semi")


def linked_items(items: DataFrame, subs: DataFrame) -> DataFrame:
    """Inventory rows with their substitutes (J10): one row per pair, or one without a substitute."""
    return left_join_on(items, subs.withColumnRenamed("item", "_sub_item"), [("item", "_sub_item")])


def with_group_metrics(linked: DataFrame, quantities: DataFrame) -> DataFrame:
    """J13 on the item side; rows without a group do not wait in one task for a group."""
    left = linked.withColumn("_g", spread_nulls("item_group", "item", "vendor_item"))
    right = quantities.select(F.col("item_group").alias("_ig"), F.col("item_group").cast("string").alias("_h"), *GROUP_METRICS)
    return left.join(right, (left["_g"] == right["_h"]) & (left["item_group"] == right["_ig"]), "left").drop("_g", "_h", "_ig")


def with_alternatives(linked: DataFrame, conversions: DataFrame) -> DataFrame:
    """``alts``: the alternatives of a row's unit key as an array (an item's packaging levels)."""
    keys = linked.select(*UOM_KEY).distinct()
    alts = alternative_table(keys, conversions).groupBy(*[F.col(k).alias(f"_u_{k}") for k in UOM_KEY]).agg(
        F.collect_list(F.struct(*ALTERNATIVE_COLUMNS)).alias("alts"))
    same = linked["vendor_item"] == alts["_u_vendor_item"]
    for k in UOM_KEY[1:]:
        same = same & linked[k].eqNullSafe(alts[f"_u_{k}"])
    return linked.join(alts, same, "left").drop(*[f"_u_{k}" for k in UOM_KEY])


def nest(rows: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """(vendor_item, entries): the rows of a vendor item as an array, in several rows of about ``entries`` if it has more."""
    many = rows.groupBy("vendor_item").agg(F.count("*").alias("_n")).where(F.col("_n") > entries).withColumnRenamed("vendor_item", "_v")
    names = [c for c in rows.columns if c != "vendor_item"]
    plain = [c for c in names if not rows.schema[c].dataType.typeName() == "array"]
    part = F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.xxhash64(*plain), F.ceil(F.col("_n") / entries)))
    split = rows.join(many, rows["vendor_item"] == many["_v"], "left").withColumn("_part", part)
    entry = F.struct(F.col("vendor_item").alias("inv_vendor_item"), *names)
    return split.groupBy("vendor_item", "_part").agg(F.collect_list(entry).alias("entries")).drop("_part")


def item_side(linked: DataFrame, group_usage_total: DataFrame, conversions: DataFrame) -> DataFrame:
    """The nested item side of the vendor items of a feed, from their :func:`linked_items`."""
    whole = with_group_metrics(linked, group_quantities(linked, group_usage_total))
    return nest(with_alternatives(whole, conversions))


def join_feed(feed: DataFrame, nested: DataFrame, as_of: datetime, threshold: float) -> DataFrame:
    """Feed lines with all that their vendor item gives (J9, C4, J10, P26, J13): one row per line and entry, or
    one unmatched row. ``alts`` stays an array."""
    # the days are read from text once for a line, ahead of the join, not in the expressions of every entry behind it
    left = feed.withColumn("_key", spread_nulls("vendor_item", "row_id")).withColumn("_days", days_to_recover(as_of))
    right = nested.select(F.col("vendor_item").alias("_item_key"), F.col("vendor_item").cast("string").alias("_text_key"), "entries")
    met = left.join(right, (left["_key"] == right["_text_key"]) & (left["vendor_item"] == right["_item_key"]), "left")
    rows = met.select(*feed.columns, "_days", F.explode_outer("entries").alias("_e"))
    fields = nested.schema["entries"].dataType.elementType.names
    rows = rows.select(*feed.columns, "_days", *[F.col(f"_e.{c}").alias(c) for c in fields], F.col("_e").isNotNull().alias("_matched"))
    return group_gap(type_feed_columns(coverage_metrics(rows, as_of, threshold, F.col("_days")).drop("_days")), threshold)
