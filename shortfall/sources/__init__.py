"""Sources: scans of the shortage feed and of the inventory-side tables.

Each reader is a lazy DataFrame transformation; filters and projections are
expressed before any aggregate so Catalyst pushes them into the Parquet/JDBC
scan (``PushedFilters`` / pruned ``ReadSchema``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shortfall.functions import na_normalise, stamp_text, ts_lit
from shortfall.operators.ordinal import latest_per_key

# Raw feed columns in report order (all text).
FEED_COLUMNS = (
    "risk_level", "customer_material_number", "vendor_item", "mioh", "manufacturer_item",
    "material_description", "sold_to", "sold_to_name", "forecast_qty", "branch",
    "on_allocation", "packaging_string", "est_depletion_date", "est_available_date",
    "duration", "est_delivery_date", "doc_appointment_date", "parent_item",
)

# Columns a feed must carry before processing starts.
REQUIRED_COLUMNS = (
    "risk_level", "customer_material_number", "vendor_item", "manufacturer_item",
    "material_description", "on_allocation", "packaging_string", "est_available_date",
    "parent_item", "duration", "forecast_qty",
)

FEED_SCHEMA = StructType([StructField(c, StringType(), True) for c in FEED_COLUMNS])


# Types the joins rely on (the source database's own types are unknown):
# keys and unit codes as text, quantities and multipliers as DOUBLE.
TEXT_COLUMNS = ("location", "item", "vendor_item", "stock_uom", "default_buy_uom", "item_group",
                "replace_item", "stage", "description3")
NUMBER_COLUMNS = ("buy_uom_multiplier", "available_qty", "on_order_qty", "qty", "rolling_daily_avg_7")


def normalise_types(df: DataFrame) -> DataFrame:
    """Cast the known key / unit columns to STRING and quantities to DOUBLE
    (no-op when they already have those types)."""
    types = dict(df.dtypes)
    casts = {c: F.col(c).cast("string") for c in TEXT_COLUMNS if c in types and types[c] != "string"}
    casts.update({c: F.col(c).cast("double") for c in NUMBER_COLUMNS if c in types and types[c] != "double"})
    return df.withColumns(casts) if casts else df


def _locations(locations: str | Sequence[str]) -> list[str]:
    return [locations] if isinstance(locations, str) else list(locations)


# ── S1 / D1: feed ────────────────────────────────────────────────────

def read_feed(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a landed feed as text columns and drop duplicate lines.

    CSV columns are bound by header name, whatever their order; files whose headers differ from
    each other fail instead of shifting columns. Names not in ``FEED_COLUMNS`` are left out,
    missing ones stay missing for :func:`validate_columns` to report.
    """
    if fmt == "csv":
        raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
        raw = raw.toDF(*[c.strip() for c in raw.columns])
    else:
        raw = spark.read.format(fmt).load(path)
    return dedup_feed(raw.select(*[c for c in FEED_COLUMNS if c in raw.columns]))


def dedup_feed(feed: DataFrame) -> DataFrame:
    """NA tokens -> NULL on every text column, then distinct over all columns
    (NULL equals NULL). Map-side partial dedup keeps the shuffle small."""
    cols = [na_normalise(F.col(c).cast("string")).alias(c) for c in feed.columns]
    return feed.select(*cols).dropDuplicates()


# ── S2: required-column check (schema only, no job) ──────────────────

def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def validate_columns(df: DataFrame, required: Sequence[str] | str = REQUIRED_COLUMNS) -> bool:
    """Raise ``ValueError`` naming every missing column, in the required order.

    ``required="report"`` checks every raw column the report needs.
    """
    if required == "report":
        required = FEED_COLUMNS
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"the feed lacks required columns: {', '.join(missing)}")
    return True


# ── S3: location-scoped scans ────────────────────────────────────────

def scan_locations(df: DataFrame, locations: str | Sequence[str], collation: str | None = None) -> DataFrame:
    """Filter to the given locations (pushed to the scan as an IN filter).

    ``collation="UTF8_LCASE"`` matches case-insensitively, for sources whose
    database compares text that way (such a filter is not pushed down)."""
    loc = F.col("location") if collation is None else F.collate(F.col("location"), collation)
    return df.filter(loc.isin(_locations(locations)))


def _active(df: DataFrame, locations, collation: str | None = None) -> DataFrame:
    return scan_locations(df, locations, collation).filter(
        (F.col("active") == "Yes") & (F.col("discontinued") == "No"))


# ── S4 / P2 / W1: latest active inventory snapshot ───────────────────

# columns of the snapshot the coverage job reads downstream
JOB_INVENTORY_COLUMNS = (
    "location", "item", "vendor_item", "stock_uom", "default_buy_uom", "buy_uom_multiplier",
    "available_qty", "on_order_qty", "report_stamp",
)


def active_inventory(inv: DataFrame, locations: str | Sequence[str], collation: str | None = None) -> DataFrame:
    """Active, not discontinued snapshot rows of the locations, typed."""
    return normalise_types(_active(inv, locations, collation))


def located_usage(usage: DataFrame, locations: str | Sequence[str], collation: str | None = None) -> DataFrame:
    """Usage transactions of the locations, typed."""
    return normalise_types(scan_locations(usage, locations, collation))


def latest_inventory(inv: DataFrame, locations: str | Sequence[str],
                     tie_break: Sequence[str] = (), columns: Sequence[str] | None = None,
                     collation: str | None = None) -> DataFrame:
    """Newest *active* snapshot row per (location, item).

    Filters run before ranking. Ordering: ``report_stamp DESC NULLS LAST`` then
    ``tie_break`` columns descending; every key is limited to one row per map
    task before the shuffle. ``columns`` narrows the carried row first, so that wide
    descriptive columns are not sorted for nothing.
    """
    rows = active_inventory(inv, locations, collation)
    if columns is not None:
        keep = list(dict.fromkeys([*columns, "report_stamp", *tie_break]))
        rows = rows.select(*keep)
    return latest_per_key(rows, ["location", "item"], ["report_stamp", *tie_break])


# ── S5 / P4 / A5: average daily issue ────────────────────────────────

def avg_daily_issue(usage: DataFrame, locations: str | Sequence[str], as_of: datetime,
                    window_days: int = 366, divisor: int = 365, collation: str | None = None) -> DataFrame:
    """sum(qty) / divisor per (location, item) over ``[as_of - window, as_of]``.

    The window (366 days) and the divisor (365) differ on purpose. A group whose
    quantities are all NULL yields NULL (SQL sum).
    """
    lo = as_of - timedelta(days=window_days)
    rows = normalise_types(scan_locations(usage, locations, collation).filter(
        F.col("trx_date").between(ts_lit(lo), ts_lit(as_of))))
    return rows.groupBy("location", "item").agg(
        (F.sum("qty") / F.lit(float(divisor))).alias("avg_daily_issue"))


# ── S6 / S7 / S8: dimension scans ────────────────────────────────────

def item_descriptions(desc: DataFrame) -> DataFrame:
    """(item, description3); not unique per item -- duplicates fan out joins."""
    return normalise_types(desc.select("item", "description3"))


def active_links(links: DataFrame, excluded_stages: Sequence[str]) -> DataFrame:
    """Substitute links whose stage is not excluded; a NULL stage is dropped
    too (three-valued NOT IN)."""
    return normalise_types(links.select("item_group", "item", "replace_item", "stage")).filter(
        ~F.col("stage").isin(list(excluded_stages)))


def group_usage(gu: DataFrame, locations: str | Sequence[str], collation: str | None = None) -> DataFrame:
    return normalise_types(scan_locations(gu, locations, collation).select("item_group", "rolling_daily_avg_7"))


# ── S9 / A6 / P22: inventory freshness scalar ────────────────────────

def inventory_freshness(inv: DataFrame, locations: str | Sequence[str], as_of: datetime,
                        days: int = 10, collation: str | None = None) -> DataFrame:
    """One row: newest active report stamp no older than ``days``; NULL when
    nothing is fresh. ``stamp_text`` is the 19-character ISO form."""
    fresh = _active(inv, locations, collation).filter(
        F.col("report_stamp") >= ts_lit(as_of - timedelta(days=days)))
    return fresh.agg(F.max("report_stamp").alias("stamp")).select(
        "stamp", stamp_text("stamp").alias("stamp_text"))


def freshness_from_latest(latest: DataFrame, as_of: datetime, days: int = 10) -> DataFrame:
    """S9 from the latest-snapshot table instead of the full history: each
    key's latest active row holds that key's newest active stamp, so the
    overall newest stamp is the same -- without a second scan of the history."""
    fresh = latest.filter(F.col("report_stamp") >= ts_lit(as_of - timedelta(days=days)))
    return fresh.agg(F.max("report_stamp").alias("stamp")).select(
        "stamp", stamp_text("stamp").alias("stamp_text"))


# ── S10 / W4 / W5: newest feed file per feed ─────────────────────────

def latest_arrival(arrivals: DataFrame, as_of: datetime, keyword: str, prefix: str,
                   max_messages: int = 100, lookback_hours: int = 48,
                   inbox: str = "inbox", fallback_folder: str = "archive",
                   extension: str = ".xlsx") -> DataFrame:
    """Pick the feed file to process, per ``feed``, with a two-tier rule.

    ``feed`` identifies the mailbox (source) being searched: the newest-N
    rank covers all messages of that mailbox folder, before any filter, as
    the mail API lists a folder's newest messages.

    Tier 1 (inbox): among the newest ``max_messages`` inbox messages (ranked
    before any filter), subject contains ``keyword`` (case-insensitive) and
    received within ``lookback_hours``. Tier 2 (fallback folder): newest
    ``max_messages`` messages there, no subject or time filter. In both tiers
    the attachment is a file whose name starts with ``prefix`` and ends with
    ``extension`` (case-insensitive). An inbox hit always wins.

    The top-N rank is a filtered ``dense_rank`` (Spark inserts a partial
    group limit before the shuffle, so a hot folder stays cheap); the final
    choice is a filtered ``row_number`` with the same limit.
    """
    msg_order = Window.partitionBy("feed", "folder").orderBy(
        F.col("received_at").desc(), F.col("message_id").desc())
    scoped = arrivals.filter(F.col("folder").isin(inbox, fallback_folder))
    ranked = scoped.withColumn("_rank", F.dense_rank().over(msg_order)).filter(
        F.col("_rank") <= max_messages)
    name = F.lower(F.col("file_name"))
    name_ok = (F.col("attachment_type") == "file") & name.startswith(prefix.lower()) & \
        name.endswith(extension.lower())
    inbox_ok = (F.col("folder") == inbox) & F.lower(F.col("subject")).contains(keyword.lower()) & (
        F.col("received_at") >= ts_lit(as_of - timedelta(hours=lookback_hours)))
    tier = F.when(inbox_ok, F.lit(1)).when(F.col("folder") == fallback_folder, F.lit(2))
    cand = ranked.filter(name_ok).withColumn("tier", tier).filter(F.col("tier").isNotNull())
    best = latest_per_key(
        cand.select("feed", "tier", "message_id", "file_name", "received_at", "attachment_pos"),
        ["feed"], [-F.col("tier"), F.col("received_at"), F.col("message_id"), -F.col("attachment_pos")])
    return best.select("feed", "tier", "message_id", "file_name", "received_at")


def require_arrival(chosen: DataFrame, feed: str) -> DataFrame:
    """The chosen file of one feed; raise when there is none."""
    one = chosen.filter(F.col("feed") == feed)
    if one.isEmpty():
        raise FileNotFoundError(f"no feed file found for {feed!r}")
    return one

