"""C1 -- multi-location reconciliation of inventory and usage.

UOM consistency is checked per (vendor_item, item) across locations; the
secondary location's rows of inconsistent items are excluded before the
cross-location sums. Key sets stay DataFrames (semi / anti joins), never
driver-side collections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns that must agree across locations, and the keys of
# the cross-location inventory sum.
CONSISTENCY_COLUMNS = ("stock_uom", "default_buy_uom", "buy_uom_multiplier")
AGGREGATION_KEYS = ("vendor_item", "item", "default_buy_uom", "buy_uom_multiplier", "stock_uom")
INCONSISTENCY_COLUMNS = (
    "location", "vendor_item", "item", "available_qty", "on_order_qty",
    "default_buy_uom", "buy_uom_multiplier", "stock_uom", "report_stamp",
)


def _stats(c: str) -> list:
    return [F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"),
            F.count(c).alias(f"_nn_{c}")]


def _several_values(c: str):
    """More than one distinct value with NULL counted as a value: two non-NULL
    values differ, or NULL and non-NULL values are mixed. Built from min, max
    and counts, so it aggregates partially (no distinct-count expansion)."""
    return (F.col(f"_lo_{c}") != F.col(f"_hi_{c}")) | (
        (F.col(f"_nn_{c}") > 0) & (F.col(f"_nn_{c}") < F.col("_rows")))


def uom_inconsistent_keys(inv: DataFrame) -> DataFrame:
    """(vendor_item, item) keys with more than one value in any consistency
    column (A1). Rows with a NULL key are not examined."""
    keyed = inv.filter(F.col("vendor_item").isNotNull() & F.col("item").isNotNull())
    stats = keyed.groupBy("vendor_item", "item").agg(
        F.count(F.lit(1)).alias("_rows"), *[e for c in CONSISTENCY_COLUMNS for e in _stats(c)])
    bad = None
    for c in CONSISTENCY_COLUMNS:
        cond = F.coalesce(_several_values(c), F.lit(False))
        bad = cond if bad is None else bad | cond
    return stats.filter(bad).select("vendor_item", "item")


def uom_inconsistency_rows(inv: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Raw rows (all locations) of inconsistent keys (J1), sorted (O2)."""
    keys = uom_inconsistent_keys(inv) if keys is None else keys
    rows = inv.join(keys, ["vendor_item", "item"], "left_semi").select(*INCONSISTENCY_COLUMNS)
    return rows


def sort_inconsistency_rows(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("vendor_item").asc_nulls_last(), F.col("item").asc_nulls_last(),
                        F.col("location").asc_nulls_last())


def secondary_items(inv: DataFrame, secondary: str) -> DataFrame:
    """Distinct items stocked at the secondary location (taken before P5)."""
    return inv.filter((F.col("location") == secondary) & F.col("item").isNotNull()) \
        .select("item").distinct()


def drop_secondary_inconsistent(df: DataFrame, bad_items: DataFrame, secondary: str) -> DataFrame:
    """P5: drop secondary-location rows whose item is inconsistent. Exclusion
    is by item only; rows with a NULL item or location are kept."""
    bad = bad_items.select(F.col("item").alias("_bad_item"))
    cond = (df["item"] == bad["_bad_item"]) & (df["location"] == F.lit(secondary))
    return df.join(bad, cond, "left_anti")


def aggregate_inventory(inv: DataFrame) -> DataFrame:
    """A2: sum quantities across locations, newest stamp; NULL keys form
    groups; an all-NULL sum is 0.0."""
    return inv.groupBy(*AGGREGATION_KEYS).agg(
        F.coalesce(F.sum("available_qty"), F.lit(0.0)).alias("available_qty"),
        F.coalesce(F.sum("on_order_qty"), F.lit(0.0)).alias("on_order_qty"),
        F.max("report_stamp").alias("report_stamp"),
    )


def aggregate_usage(usage: DataFrame) -> DataFrame:
    """A3: average daily issue summed across locations per item."""
    return usage.groupBy("item").agg(
        F.coalesce(F.sum("avg_daily_issue"), F.lit(0.0)).alias("avg_daily_issue"))


def aggregate_group_usage(gu: DataFrame) -> DataFrame:
    """A4: rolling group usage summed across locations per item group."""
    return gu.groupBy("item_group").agg(
        F.coalesce(F.sum("rolling_daily_avg_7"), F.lit(0.0)).alias("rolling_daily_avg_7"))


def reconcile_locations(inv: DataFrame, usage: DataFrame, gu: DataFrame,
                        secondary: str) -> dict[str, DataFrame]:
    """Inventory, usage and group usage combined across locations, plus
    the inconsistency rows and the secondary-location item set."""
    keys = uom_inconsistent_keys(inv)
    bad_items = keys.select("item").distinct()
    return {
        "inventory": aggregate_inventory(drop_secondary_inconsistent(inv, bad_items, secondary)),
        "usage": aggregate_usage(drop_secondary_inconsistent(usage, bad_items, secondary)),
        "group_usage": aggregate_group_usage(gu),
        "uom_inconsistency": uom_inconsistency_rows(inv, keys),
        "secondary_items": secondary_items(inv, secondary),
    }
