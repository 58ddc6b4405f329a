"""Query catalogue: one Spark query per operator family, each over the whole
fixture views of ``shortfall.plans.fixtures`` (see ``oracle.py`` for the
matching DuckDB SQL)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall import sources as S
from shortfall.operators import audit as A
from shortfall.operators import coverage as C
from shortfall.operators import incremental as INC
from shortfall.operators import reconcile as RC
from shortfall.operators import report as RP
from shortfall.operators import retention as RT
from shortfall.operators import uom as U
from shortfall.plans import fixtures as X
from shortfall.plans.job import Params, Stages, build_stages, prepare_feed

PARAMS = Params(
    coverage_as_of=X.COVERAGE_AS_OF,
    usage_as_of=X.USAGE_AS_OF,
    freshness_as_of=X.FRESHNESS_AS_OF,
    locations=X.LOCATIONS,
    secondary_location=X.SECONDARY_LOCATION,
    usage_window_days=X.USAGE_WINDOW_DAYS,
    usage_divisor=X.USAGE_DIVISOR,
    freshness_days=X.FRESHNESS_DAYS,
    excluded_stages=X.EXCLUDED_STAGES,
    risk_levels=X.RISK_LEVELS,
    duration_threshold=X.DURATION_THRESHOLD,
    review_threshold=X.REVIEW_THRESHOLD,
    inventory_tie_break=("l_orderkey", "l_linenumber", "l_extendedprice"),
    row_order=("customer_material_number",),
)
AUDIT_RUN_TIME = datetime(2024, 1, 31, 6, 0, 0)
AUDIT_DURATION_SECONDS = 42


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "feed": X.load(spark, sf_dir, "fx_feed"),
        "inventory": X.load(spark, sf_dir, "fx_inventory"),
        "usage": X.load(spark, sf_dir, "fx_usage"),
        "descriptions": X.load(spark, sf_dir, "fx_description"),
        "links": X.load(spark, sf_dir, "fx_item_link"),
        "group_usage": X.load(spark, sf_dir, "fx_group_usage"),
    }


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    return build_stages(inputs(spark, sf_dir), PARAMS)


def _latest(spark, d):
    return S.latest_inventory(X.load(spark, d, "fx_inventory"), PARAMS.locations, PARAMS.inventory_tie_break)


def _avg_issue(spark, d):
    return S.avg_daily_issue(X.load(spark, d, "fx_usage"), PARAMS.locations, PARAMS.usage_as_of,
                             PARAMS.usage_window_days, PARAMS.usage_divisor)


def q_latest_inventory_merged(spark, d):
    """The latest rows of the snapshots before a day, merged with all other snapshots."""
    rows = S.active_inventory(X.load(spark, d, "fx_inventory"), PARAMS.locations)
    newer = F.coalesce(F.col("report_stamp") >= F.lit("1996-01-01").cast("timestamp"), F.lit(True))
    how = (["location", "item"], "report_stamp", ("l_orderkey", "l_linenumber", "l_extendedprice"))
    return INC.merge_latest(INC.merge_latest(None, rows.where(~newer), *how), rows.where(newer), *how)


def q_avg_daily_issue_by_day(spark, d):
    usage = S.located_usage(X.load(spark, d, "fx_usage"), PARAMS.locations)
    return INC.usage_from_days(INC.daily_usage(usage), usage, PARAMS.usage_as_of, PARAMS.usage_window_days, PARAMS.usage_divisor)


def q_latest_inventory(spark, d):
    return _latest(spark, d)


def q_avg_daily_issue(spark, d):
    return _avg_issue(spark, d)


def q_item_description(spark, d):
    return S.item_descriptions(X.load(spark, d, "fx_description"))


def q_active_links(spark, d):
    return S.active_links(X.load(spark, d, "fx_item_link"), PARAMS.excluded_stages)


def q_group_usage_total(spark, d):
    return RC.aggregate_group_usage(S.group_usage(X.load(spark, d, "fx_group_usage"), PARAMS.locations))


def q_inventory_freshness(spark, d):
    return S.inventory_freshness(X.load(spark, d, "fx_inventory"), PARAMS.locations,
                                 PARAMS.freshness_as_of, PARAMS.freshness_days)


def q_latest_arrival(spark, d):
    return S.latest_arrival(X.load(spark, d, "fx_arrivals"), X.ARRIVALS_AS_OF, X.ARRIVALS_KEYWORD,
                            X.ARRIVALS_PREFIX, max_messages=X.ARRIVALS_MAX_MESSAGES,
                            lookback_hours=X.ARRIVALS_LOOKBACK_HOURS,
                            fallback_folder=X.ARRIVALS_FALLBACK_FOLDER)


def q_feed_dedup(spark, d):
    feed = X.load(spark, d, "fx_feed")
    return S.dedup_feed(feed.unionByName(feed))


def q_risk_selection(spark, d):
    feed = S.dedup_feed(X.load(spark, d, "fx_feed"))
    return C.risk_selection(feed, PARAMS.risk_levels, PARAMS.duration_threshold).select(
        "customer_material_number", "risk_level", "duration", "forecast_qty", "risk_selected")


def q_uom_inconsistency(spark, d):
    return stages(spark, d)["reconciled_uom_inconsistency"]


def q_reconciled_inventory(spark, d):
    return stages(spark, d)["reconciled_inventory"]


def q_reconciled_usage(spark, d):
    return stages(spark, d)["reconciled_usage"]


def q_enriched_inventory(spark, d):
    return stages(spark, d)["enriched_inventory"]


def q_substitutes(spark, d):
    return stages(spark, d)["substitutes"]


def q_feed_row_id(spark, d):
    return prepare_feed(X.load(spark, d, "fx_feed"), PARAMS).select(
        "row_id", "customer_material_number", "vendor_item", "risk_selected")


COVERAGE_COLUMNS = (
    "row_id", "vendor_item", "inv_vendor_item", "item", "available_qty", "avg_daily_issue",
    "description3", "dioh", "days_to_recover", "coverage_gap", "review_flag", "match_status",
    "no_issue_flag",
)


def q_coverage_metrics(spark, d):
    return stages(spark, d)["coverage"].select(*COVERAGE_COLUMNS)


SUBSTITUTE_VIEW = (
    "row_id", "item", "item_group", "replace_item", "stage", "repl_vendor_item", "repl_available_qty",
    "repl_avg_daily_issue", "repl_dioh", "with_sub", "est_delivery_date", "duration", "forecast_qty", "mioh",
)


def q_feed_with_substitutes(spark, d):
    return stages(spark, d)["feed_with_substitutes"].select(*SUBSTITUTE_VIEW)


def q_group_coverage(spark, d):
    return stages(spark, d)["group_coverage"].select(
        "item_group", "available_qty_ig", "avg_daily_issue_ig", "dioh_ig", "item", "coverage_gap_ig",
        "review_flag_ig")


FULL_VIEW = (
    "row_id", "item", "item_group", "replace_item", "coverage_gap", "review_flag",
    "available_qty_ig", "avg_daily_issue_ig", "dioh_ig", "coverage_gap_ig", "review_flag_ig",
)


def q_full_dataset(spark, d):
    return stages(spark, d)["full"].select(*FULL_VIEW)


def q_recommendations(spark, d):
    return stages(spark, d)["review"]


def q_packaging_parse(spark, d):
    feed = S.dedup_feed(X.load(spark, d, "fx_feed"))
    return U.parse_packaging(feed, carry=["customer_material_number"])


def q_uom_conversions(spark, d):
    feed = S.dedup_feed(X.load(spark, d, "fx_feed"))
    return U.build_conversions(U.parse_packaging(feed))


def q_unresolved_uom(spark, d):
    return stages(spark, d)["unresolved_uom"]


def q_uom_alternatives(spark, d):
    return stages(spark, d)["uom_alternatives"]


def q_final_report(spark, d):
    return stages(spark, d)["report"]


def q_batch_label(spark, d):
    arr = X.load(spark, d, "fx_arrivals")
    return arr.select("message_id", "file_name",
                      RP.batch_label("file_name", X.LABEL_TOKEN).alias("batch_label"))


def _orders(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderdate", "o_orderstatus")


def q_retention_split(spark, d):
    return RT.retention_split(_orders(spark, d), "o_orderdate", X.RETENTION_AS_OF, X.RETENTION_DAY_RANGE)


def q_retention_purge(spark, d):
    return RT.retention_purge(_orders(spark, d), "o_orderdate", X.RETENTION_AS_OF, X.RETENTION_DAY_RANGE)


def q_run_audit(spark, d):
    st = stages(spark, d)
    counters = A.run_counters(st["feed"], st["report"])
    row = A.audit_row(counters, process_name="shortfall", process_id="1", source_file_path=None,
                      last_run_time=AUDIT_RUN_TIME, task_status="SUCCESS",
                      duration_seconds=AUDIT_DURATION_SECONDS, package_path="jobs/shortfall",
                      log_file_path=None, process_frequency="weekly")
    return row.crossJoin(counters.select("selected_rows", "output_rows"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_inventory": q_latest_inventory,
    "avg_daily_issue": q_avg_daily_issue,
    "latest_inventory_merged": q_latest_inventory_merged,
    "avg_daily_issue_by_day": q_avg_daily_issue_by_day,
    "item_description": q_item_description,
    "active_links": q_active_links,
    "group_usage_total": q_group_usage_total,
    "inventory_freshness": q_inventory_freshness,
    "latest_arrival": q_latest_arrival,
    "feed_dedup": q_feed_dedup,
    "risk_selection": q_risk_selection,
    "uom_inconsistency": q_uom_inconsistency,
    "reconciled_inventory": q_reconciled_inventory,
    "reconciled_usage": q_reconciled_usage,
    "enriched_inventory": q_enriched_inventory,
    "substitutes": q_substitutes,
    "feed_row_id": q_feed_row_id,
    "coverage_metrics": q_coverage_metrics,
    "feed_with_substitutes": q_feed_with_substitutes,
    "group_coverage": q_group_coverage,
    "full_dataset": q_full_dataset,
    "recommendations": q_recommendations,
    "packaging_parse": q_packaging_parse,
    "uom_conversions": q_uom_conversions,
    "unresolved_uom": q_unresolved_uom,
    "uom_alternatives": q_uom_alternatives,
    "final_report": q_final_report,
    "batch_label": q_batch_label,
    "retention_split": q_retention_split,
    "retention_purge": q_retention_purge,
    "run_audit": q_run_audit,
}
