"""C2 / C3 -- inventory enriched with usage and descriptions, and the
substitute table. All joins are left joins. NULL keys match nothing by default;
``null_keys="match"`` lets them match each other (n x m rows for one key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortfall.functions import ieee_div

# The enriched inventory's columns taken from the inventory.
ENRICHED_COLUMNS = (
    "vendor_item", "item", "available_qty", "on_order_qty", "default_buy_uom",
    "buy_uom_multiplier", "stock_uom", "report_stamp",
)


def keys_equal(left: Column, right: Column, null_keys: str = "drop") -> Column:
    """Join equality: NULL keys match nothing (``drop``) or NULL keys (``match``)."""
    if null_keys not in ("match", "drop"):
        raise ValueError(f"null_keys must be 'match' or 'drop', not {null_keys!r}")
    return left.eqNullSafe(right) if null_keys == "match" else left == right


def left_join_on(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                 null_keys: str = "drop", how: str = "left") -> DataFrame:
    """Join ``left`` to ``right`` on (left_col, right_col) pairs; the right key
    columns are dropped."""
    tmp = {rk: f"_k{i}" for i, (_, rk) in enumerate(on)}
    r = right
    for rk, t in tmp.items():
        r = r.withColumnRenamed(rk, t)
    cond = None
    for lk, rk in on:
        c = keys_equal(left[lk], r[tmp[rk]], null_keys)
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*tmp.values())


def dioh(qty: str, use: str):
    """Days of inventory on hand; a zero quantity is 0.0 whatever the usage."""
    return F.when(F.col(qty) == 0, F.lit(0.0)).otherwise(ieee_div(qty, use))


def enrich_inventory(inv: DataFrame, usage: DataFrame, desc: DataFrame,
                     secondary_items: DataFrame | None = None, null_keys: str = "drop") -> DataFrame:
    """Reconciled inventory + summed usage + descriptions.

    With ``secondary_items`` the per-item ``in_secondary_location`` flag (J21,
    P23) is set here, on the small per-item table, so it reaches the feed
    rows through the existing feed-to-inventory join instead of a join on the
    largest table."""
    base = inv.select(*ENRICHED_COLUMNS)
    out = left_join_on(base, usage.select("item", "avg_daily_issue"), [("item", "item")], null_keys)
    out = left_join_on(out, desc.select("item", "description3"), [("item", "item")], null_keys)
    if secondary_items is not None:
        s = secondary_items.select(F.col("item").alias("_si"), F.lit("Yes").alias("in_secondary_location"))
        out = out.join(s, out["item"] == s["_si"], "left").drop("_si").fillna(
            "No", subset=["in_secondary_location"])
    return out


def build_substitutes(links: DataFrame, inv: DataFrame, usage: DataFrame,
                      desc: DataFrame, null_keys: str = "drop") -> DataFrame:
    """Active links with the replacement item's inventory, usage,
    description and DIOH (J6-J8, P11). Replacement columns are ``repl_*``."""
    r_inv = inv.select(
        F.col("item").alias("_ri"), F.col("vendor_item").alias("repl_vendor_item"),
        F.col("available_qty").alias("repl_available_qty"),
        F.col("on_order_qty").alias("repl_on_order_qty"),
        F.col("default_buy_uom").alias("repl_default_buy_uom"),
        F.col("buy_uom_multiplier").alias("repl_buy_uom_multiplier"),
        F.col("stock_uom").alias("repl_stock_uom"))
    r_use = usage.select(F.col("item").alias("_ri"), F.col("avg_daily_issue").alias("repl_avg_daily_issue"))
    r_desc = desc.select(F.col("item").alias("_ri"), F.col("description3").alias("repl_description3"))
    out = left_join_on(links, r_inv, [("replace_item", "_ri")], null_keys)
    out = left_join_on(out, r_use, [("replace_item", "_ri")], null_keys)
    out = left_join_on(out, r_desc, [("replace_item", "_ri")], null_keys)
    return out.withColumn("repl_dioh", dioh("repl_available_qty", "repl_avg_daily_issue")) \
        .withColumn("with_sub", F.lit("With Sub"))
