"""C5 / J13 -- item-group coverage.

Group quantity counts the feed's items and their replacement items once per
(item, group, quantity) tuple -- an item that is both item and replacement in
a group counts twice. Group DIOH has no zero override (0/0 -> NULL, x/0 -> inf).

Group metrics are attached to each row through its own ``item_group`` and its
own ``days_to_recover``; the group gap is computed per row. This yields one row
per input row (no pairing of an item's rows with each other).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions import ieee_div, review_flag, safe_sub


def group_quantities(msub: DataFrame, group_usage_total: DataFrame) -> DataFrame:
    """A7 + J11: per item group: summed quantity, group usage and DIOH."""
    has_ig = msub.filter(F.col("item_group").isNotNull())
    # one pass: each row contributes its item side and its replacement side;
    # the side tag keeps the two dedups separate (D2), so an item that is both
    # an item and a replacement in the group counts twice
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("item").alias("member"), F.col("available_qty").alias("qty")),
        F.struct(F.lit(1).alias("side"), F.col("replace_item").alias("member"),
                 F.col("repl_available_qty").alias("qty")))
    members = has_ig.select("item_group", F.explode(sides).alias("m")) \
        .select("item_group", "m.side", "m.member", "m.qty").distinct()
    qty = members.groupBy("item_group").agg(F.coalesce(F.sum("qty"), F.lit(0.0)).alias("available_qty_ig"))
    use = group_usage_total.select("item_group", F.col("rolling_daily_avg_7").alias("avg_daily_issue_ig"))
    return qty.join(use, "item_group", "left").withColumn(
        "dioh_ig", ieee_div("available_qty_ig", "avg_daily_issue_ig"))


def group_coverage(msub: DataFrame, ig_qty: DataFrame, threshold: float) -> DataFrame:
    """C5 output: one row per distinct (item, item_group, days_to_recover) with
    the group gap and flag (D3, J12)."""
    days = msub.filter(F.col("item_group").isNotNull()) \
        .select("item", "item_group", "days_to_recover").distinct()
    out = ig_qty.join(days, "item_group", "left")
    return out.withColumn("coverage_gap_ig", safe_sub("days_to_recover", "dioh_ig")) \
        .withColumn("review_flag_ig", review_flag("coverage_gap_ig", threshold))


def full_dataset(msub: DataFrame, ig_qty: DataFrame, threshold: float) -> DataFrame:
    """Every row gets its group's metrics and its own group gap; rows
    without a group keep NULL group columns and a NULL group flag."""
    g = ig_qty.withColumnRenamed("item_group", "_ig")
    out = msub.join(g, msub["item_group"] == g["_ig"], "left").drop("_ig")
    return group_gap(out, threshold)


def group_gap(df: DataFrame, threshold: float) -> DataFrame:
    """The row's own group gap and flag; NULL without a group."""
    gap = safe_sub("days_to_recover", "dioh_ig")
    return df.withColumn("coverage_gap_ig", F.when(F.col("item_group").isNotNull(), gap)) \
        .withColumn("review_flag_ig", F.when(F.col("item_group").isNotNull(),
                                             review_flag("coverage_gap_ig", threshold)))
