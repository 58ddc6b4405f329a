"""C6 -- order recommendations for rows flagged for review."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions import ceil_double, clamp_min0, ieee_div, safe_mul, safe_sub

# The columns a review row carries into the recommendation.
REVIEW_COLUMNS = (
    "vendor_item", "packaging_string", "item", "review_flag", "with_sub", "review_flag_ig",
    "item_group", "replace_item", "avg_daily_issue", "avg_daily_issue_ig",
    "default_buy_uom", "buy_uom_multiplier", "repl_default_buy_uom", "repl_buy_uom_multiplier",
    "coverage_gap", "coverage_gap_ig",
)
RECOMMENDATION_COLUMNS = (
    "target_coverage", "target_coverage_ig", "target_qty_ea", "target_qty_ea_ig",
    "rec_qty_ea", "rec_qty_buy_uom", "rec_qty_buy_uom_repl",
)


def with_recommendations(df: DataFrame, threshold: float, only_review: bool = True) -> DataFrame:
    """Add P16-P19 as a chain of columns, each step reading the previous
    column (not a nested expression), so generated code stays small.

    With ``only_review`` the target coverages -- and so every column derived
    from them -- are NULL on rows not flagged for review."""
    t = F.lit(float(threshold))
    guard = (lambda c: F.when(F.col("review_flag") == "Review", c)) if only_review else (lambda c: c)
    out = df.withColumn("target_coverage", guard(safe_sub("coverage_gap", t)))
    out = out.withColumn("target_coverage_ig", guard(clamp_min0(safe_sub("coverage_gap_ig", t))))
    out = out.withColumn("target_qty_ea", safe_mul("target_coverage", "avg_daily_issue"))
    out = out.withColumn("target_qty_ea_ig", safe_mul("target_coverage_ig", "avg_daily_issue_ig"))
    out = out.withColumn("rec_qty_ea", F.coalesce(F.col("target_qty_ea_ig"), F.col("target_qty_ea")))
    out = out.withColumn("_per_buy", ieee_div("rec_qty_ea", "buy_uom_multiplier"))
    out = out.withColumn("_per_buy_repl", ieee_div("rec_qty_ea", "repl_buy_uom_multiplier"))
    out = out.withColumn("rec_qty_buy_uom", ceil_double("_per_buy"))
    out = out.withColumn("rec_qty_buy_uom_repl", ceil_double("_per_buy_repl"))
    return out.drop("_per_buy", "_per_buy_repl")


def review_recommendations(full: DataFrame, threshold: float, carry: tuple[str, ...] = ()) -> DataFrame:
    """Review rows (P6) with target coverage and order quantities; ``carry`` names further columns to keep."""
    review = full.filter(F.col("review_flag") == "Review").select(*REVIEW_COLUMNS, *carry)
    return with_recommendations(review, threshold, only_review=False)
