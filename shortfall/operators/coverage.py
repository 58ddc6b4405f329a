"""Feed-side operators: risk selection (P1), row ids (W2), the feed-to-
inventory match and coverage metrics (J9, C4), substitutes (J10) and the typed
feed columns (P26)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortfall.functions import (
    floor_days, review_flag, safe_sub, strict_double, strict_timestamp, ts_lit,
)
from shortfall.operators.enrich import dioh, keys_equal, left_join_on
from shortfall.operators.ordinal import sequence

# Feed text columns typed after the substitute merge.
DATE_COLUMNS = ("est_depletion_date", "est_available_date", "est_delivery_date")
NUMBER_COLUMNS = ("mioh", "forecast_qty", "duration")


def risk_selection(feed: DataFrame, risk_levels: Sequence[str], duration_threshold: float) -> DataFrame:
    """``risk_selected = 'x'`` when the risk level contains any level
    (case-insensitive regex alternation), duration >= threshold and forecast
    is not 0; otherwise ''. NULL risk or duration fails the test; a NULL
    forecast passes it (NaN != 0). Bad numeric text raises."""
    pattern = "(?i)" + "|".join(risk_levels)
    risk = F.coalesce(F.col("risk_level"), F.lit("")).rlike(pattern)
    duration = F.coalesce(strict_double("duration", "duration") >= F.lit(float(duration_threshold)), F.lit(False))
    forecast = F.coalesce(strict_double("forecast_qty", "forecast_qty") != 0, F.lit(True))
    return feed.withColumn("risk_selected", F.when(risk & duration & forecast, F.lit("x")).otherwise(F.lit("")))


def assign_row_ids(feed: DataFrame, order_by: Sequence[str | Column], name: str = "row_id",
                   folder: str | None = None) -> DataFrame:
    """Dense 1..n row id in an explicit total order (no single-partition window)."""
    return sequence(feed, order_by, name=name, folder=folder)


def match_inventory(feed: DataFrame, enriched: DataFrame, null_keys: str = "drop") -> DataFrame:
    """Feed LEFT JOIN enriched inventory on vendor_item, with a match
    marker taken from the right side.

    A line with a NULL key stays, unmatched (``null_key_report`` counts them);
    ``null_keys="match"`` pairs every such line with every inventory row
    without a key, as the spreadsheet merge does.
    """
    right = enriched.withColumnRenamed("vendor_item", "inv_vendor_item").withColumn("_matched", F.lit(True))
    return feed.join(right, keys_equal(feed["vendor_item"], right["inv_vendor_item"], null_keys), "left")


def null_key_report(feed: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row: feed and inventory rows whose vendor_item is NULL, and the
    rows their NULL-to-NULL matching adds (``null_keys="match"``)."""
    f = feed.agg(F.count(F.when(F.col("vendor_item").isNull(), 1)).cast("bigint").alias("feed_null_keys"))
    e = enriched.agg(F.count(F.when(F.col("vendor_item").isNull(), 1)).cast("bigint").alias("inventory_null_keys"))
    return f.crossJoin(e).withColumn("null_key_pairs", F.col("feed_null_keys") * F.col("inventory_null_keys"))


def days_to_recover(as_of: datetime) -> Column:
    """Days from the as-of time to a feed line's delivery date."""
    return floor_days(strict_timestamp("est_delivery_date", "est_delivery_date"), ts_lit(as_of))


def coverage_metrics(matched: DataFrame, as_of: datetime, threshold: float, days: Column | None = None) -> DataFrame:
    """C4: DIOH, days to recover (``days`` if the rows have them), coverage gap, review flag, match status and
    the no-issue flag (P10-P15)."""
    days = days_to_recover(as_of) if days is None else days
    m = F.coalesce(F.col("_matched"), F.lit(False))
    return (matched
            .withColumn("dioh", dioh("available_qty", "avg_daily_issue"))
            .withColumn("days_to_recover", days)
            .withColumn("coverage_gap", safe_sub("days_to_recover", "dioh"))
            .withColumn("review_flag", review_flag("coverage_gap", threshold))
            .withColumn("match_status", F.when(m, F.lit("Matched")).otherwise(F.lit("Not Matched")))
            .withColumn("no_issue_flag", F.when(m & F.col("avg_daily_issue").isNull(), F.lit("No Issue Out"))
                        .otherwise(F.lit("")))
            .drop("_matched"))


def merge_substitutes(df: DataFrame, subs: DataFrame, null_keys: str = "drop") -> DataFrame:
    """J10 + P26: LEFT JOIN substitutes on item (unmatched lines have no item and
    stay); then strict casts of the feed's date and number text columns."""
    right = subs.withColumnRenamed("item", "_sub_item")
    out = left_join_on(df, right, [("item", "_sub_item")], null_keys)
    return type_feed_columns(out)


def type_feed_columns(df: DataFrame) -> DataFrame:
    """Strict casts of the feed's date and number text columns."""
    for c in DATE_COLUMNS:
        df = df.withColumn(c, strict_timestamp(c, c))
    for c in NUMBER_COLUMNS:
        df = df.withColumn(c, strict_double(c, c))
    return df
