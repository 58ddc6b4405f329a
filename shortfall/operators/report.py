"""C9 final assembly, report layout (P9, O1, P24, P25, P27, P28) and the
report sinks (K1, K2)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions import lenient_double, lenient_timestamp, nan_to_null
from shortfall.session import drop_folder

# Report column order, by block.
BASE_REPORT = (
    "risk_level", "customer_material_number", "vendor_item", "mioh", "manufacturer_item",
    "material_description", "sold_to", "sold_to_name", "forecast_qty", "branch", "on_allocation",
    "packaging_string", "est_depletion_date", "est_available_date", "duration", "est_delivery_date",
    "doc_appointment_date", "parent_item", "risk_selected", "row_id",
)
ITEM_BLOCK = (
    "match_status", "in_secondary_location", "no_issue_flag", "report_stamp", "item",
    "inv_vendor_item", "available_qty", "on_order_qty", "default_buy_uom", "buy_uom_multiplier",
    "stock_uom", "avg_daily_issue", "dioh", "days_to_recover", "coverage_gap", "review_flag",
    "description3",
)
GROUP_BLOCK = (
    "with_sub", "item_group", "replace_item", "repl_vendor_item", "repl_available_qty",
    "repl_on_order_qty", "repl_default_buy_uom", "repl_buy_uom_multiplier", "repl_stock_uom",
    "repl_description3", "available_qty_ig", "avg_daily_issue_ig", "dioh_ig", "coverage_gap_ig",
    "review_flag_ig",
)
RECOMMEND_BLOCK = (
    "rec_qty_ea", "rec_qty_buy_uom", "rec_qty_buy_uom_repl", "alt_uom_group", "from_uom",
    "to_uom", "conv_factor", "rec_qty_alt_uom",
)
DEBUG_BLOCK = ("target_qty_ea", "target_qty_ea_ig", "target_coverage", "target_coverage_ig")
STAMP_BLOCK = ("inventory_as_of",)
REPORT_COLUMNS = BASE_REPORT + ITEM_BLOCK + GROUP_BLOCK + RECOMMEND_BLOCK + DEBUG_BLOCK + STAMP_BLOCK

# Report columns coerced to dates / numbers.
DATE_COLUMNS = ("est_depletion_date", "est_available_date", "est_delivery_date")
NUMERIC_COLUMNS = (
    "avg_daily_issue", "avg_daily_issue_ig", "available_qty", "on_order_qty", "buy_uom_multiplier",
    "repl_available_qty", "available_qty_ig", "repl_on_order_qty", "repl_buy_uom_multiplier",
    "rec_qty_ea", "rec_qty_buy_uom", "rec_qty_buy_uom_repl", "conv_factor", "rec_qty_alt_uom",
    "dioh", "dioh_ig", "coverage_gap", "coverage_gap_ig",
)


def attach_stamp(df: DataFrame, freshness: DataFrame) -> DataFrame:
    """Attach the one-row freshness stamp as text (broadcast, one row)."""
    one = freshness.select(F.col("stamp_text").alias("inventory_as_of"))
    return df.crossJoin(F.broadcast(one))


def coerce_report_types(df: DataFrame) -> DataFrame:
    """Lenient casts -- dates to TIMESTAMP_NTZ, numbers to DOUBLE; bad
    values become NULL. Already-typed columns pass through."""
    cols = {}
    for c in DATE_COLUMNS:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            cols[c] = lenient_timestamp(c)
    for c in NUMERIC_COLUMNS:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            cols[c] = lenient_double(c)
    return df.withColumns(cols) if cols else df


def reorder_columns(df: DataFrame, order=REPORT_COLUMNS) -> DataFrame:
    """Fixed column order; unlisted columns drop, a missing one fails."""
    missing = [c for c in order if c not in df.columns]
    if missing:
        raise ValueError(f"report columns missing: {missing}")
    return df.select(*order)


def gap_colour(c: str, threshold: float):
    """P25: '' -> NULL; gap >= threshold 'red', otherwise 'green'."""
    g = nan_to_null(F.col(c))
    return F.when(g.isNull(), F.lit(None).cast("string")).when(
        g >= F.lit(float(threshold)), F.lit("red")).otherwise(F.lit("green"))


def display_columns(df: DataFrame, threshold: float) -> DataFrame:
    """P24 + P25 kept as data: row visibility and coverage colour buckets."""
    return df.withColumns({
        "visible": F.col("match_status") == "Matched",
        "gap_colour": gap_colour("coverage_gap", threshold),
        "gap_ig_colour": gap_colour("coverage_gap_ig", threshold),
    })


# trailing sort keys: identical (status, gap, gap_ig) keys -- e.g. every
# unmatched row with a NULL gap -- spread over range partitions instead of
# landing in one, and the output order becomes deterministic
TIE_BREAK = ("row_id", "item", "replace_item", "alt_uom_group")


def sort_report(df: DataFrame, leading: tuple[str, ...] = ()) -> DataFrame:
    """O1: match status ascending, gaps descending, NULLs last. ``leading``
    columns (the output partition column) go first, so a partitioned write
    needs no second sort."""
    keys = [F.col(c).asc_nulls_last() for c in leading]
    keys += [F.col("match_status").asc_nulls_last(),
            nan_to_null(F.col("coverage_gap")).desc_nulls_last(),
            nan_to_null(F.col("coverage_gap_ig")).desc_nulls_last()]
    keys += [F.col(c).asc_nulls_last() for c in TIE_BREAK if c in df.columns]
    return df.orderBy(*keys)


def batch_label(file_name_col: str, token: str, prefix: str = "processed"):
    """Output name built from the text between the first and second
    ``token`` of the source file name (a literal, not a regex). A name without
    the token raises."""
    name = F.col(file_name_col)
    has = F.instr(name, F.lit(token)) > 0
    piece = F.split_part(name, F.lit(token), F.lit(2))
    return F.when(name.isNull(), F.lit(None).cast("string")).when(
        has, F.concat(F.lit(prefix), piece)).otherwise(
        F.raise_error(F.concat(F.lit("split token not in file name: "), name)).cast("string"))


def _snapshot_folder(path: str, snapshot: date) -> str:
    return f"{path.rstrip('/')}/snapshot_date={snapshot.isoformat()}"


def write_report(report: DataFrame, path: str, snapshot: date, fmt: str = "parquet") -> int:
    """K1: replace the snapshot's partition of the report, also by an empty one, and
    return its rows. Other snapshots stay."""
    folder = _snapshot_folder(path, snapshot)
    out = report.drop("snapshot_date")
    out.write.mode("overwrite").format(fmt).save(folder)
    return report.sparkSession.read.schema(out.schema).format(fmt).load(folder).count()


def write_inconsistency(rows: DataFrame, path: str, snapshot: date, fmt: str = "parquet") -> int:
    """K2: replace the snapshot's UOM-inconsistency side output and return its rows;
    without rows there is no partition. The rows are computed once."""
    n = write_report(rows, path, snapshot, fmt)
    if not n:
        drop_folder(rows.sparkSession, _snapshot_folder(path, snapshot))
    return n
