"""Analog input tables derived from the driver's parquet tables.

The coverage job reads a shortage feed, inventory snapshots, usage history,
substitute links, group usage and file arrivals. The test tables are a
TPC-H-like star schema, so each input is a *projection of a whole table* (no
row filter, no id subset): every order is a feed line, every lineitem an
inventory snapshot row, every event a usage transaction / file arrival, every
part a substitute link and a group-usage row.

Each view is one list of portable SQL expressions, rendered both as a Spark
``selectExpr`` and as DuckDB SQL text for the oracle, so the two engines see
bag-identical inputs. Quantities are integer-valued doubles, so sums and
divisions agree exactly across engines.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class View:
    table: str
    columns: tuple[tuple[str, str], ...]   # (portable SQL expression, alias)

    def sql(self) -> str:
        cols = ",\n  ".join(f"{e} AS {a}" for e, a in self.columns)
        return f"SELECT {cols}\nFROM {self.table}"

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        src = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        return src.selectExpr(*[f"{e} AS {a}" for e, a in self.columns])


_PKG = (
    "CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 12 = 0 THEN '' "
    "WHEN o_orderkey % 7 = 3 THEN concat(CAST(o_custkey % 6 + 2 AS STRING), ' EA/PK') "
    "WHEN o_custkey % 14 = 0 THEN 'EACH' "
    "WHEN o_custkey % 3 = 0 THEN concat(CAST(o_custkey % 5 + 1 AS STRING), ' EA/BX') "
    "ELSE concat(CAST(o_custkey % 5 + 1 AS STRING), ' EA/BX ', CAST(o_custkey % 4 + 2 AS STRING), "
    "' BX/CS ', CAST((o_custkey % 5 + 1) * (o_custkey % 4 + 2) AS STRING), ' EA/CS') END"
)
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

# Raw shortage feed: every column is text, as delivered.
FEED = View("orders", (
    ("CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderpriority END", "risk_level"),
    ("CAST(o_orderkey AS STRING)", "customer_material_number"),
    ("CASE WHEN o_orderkey % 50 = 0 THEN NULL "
     "WHEN o_orderkey % 340 = 20 THEN concat('X', CAST(o_custkey AS STRING)) "
     "ELSE concat('V', CAST(o_custkey AS STRING)) END", "vendor_item"),
    ("CAST(o_custkey % 9 AS STRING)", "mioh"),
    ("concat('M', CAST(o_custkey AS STRING))", "manufacturer_item"),
    ("concat('item ', CAST(o_custkey AS STRING))", "material_description"),
    ("CAST(o_custkey % 50 AS STRING)", "sold_to"),
    ("concat('customer ', CAST(o_custkey % 50 AS STRING))", "sold_to_name"),
    ("CAST(CASE WHEN o_orderkey % 80 = 0 THEN NULL WHEN o_orderkey % 60 = 0 THEN 0 "
     "ELSE CAST(floor(o_totalprice) AS BIGINT) % 500 END AS STRING)", "forecast_qty"),
    ("o_orderstatus", "branch"),
    ("CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END", "on_allocation"),
    (_PKG, "packaging_string"),
    (f"CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_DAY} END", "est_depletion_date"),
    (_DAY, "est_available_date"),
    ("CAST(CAST(floor(o_totalprice) AS BIGINT) % 60 AS STRING)", "duration"),
    (f"CASE WHEN o_orderkey % 140 = 0 THEN NULL ELSE {_DAY} END", "est_delivery_date"),
    ("CAST(NULL AS STRING)", "doc_appointment_date"),
    ("concat('P', CAST(o_custkey % 100 AS STRING))", "parent_item"),
))

# Inventory snapshots per (location, item, report_stamp).
INVENTORY = View("lineitem", (
    ("CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'B' END", "location"),
    ("concat('I', CAST(l_partkey AS STRING))", "item"),
    ("concat('part ', CAST(l_partkey AS STRING))", "item_description"),
    ("CASE WHEN l_linestatus = 'O' THEN 'Yes' ELSE 'No' END", "active"),
    ("CASE WHEN l_linenumber = 7 THEN 'Yes' ELSE 'No' END", "discontinued"),
    ("CASE WHEN l_partkey % 53 = 0 THEN NULL "
     "ELSE concat('V', CAST(l_partkey AS STRING)) END", "vendor_item"),
    ("concat('S', CAST(l_suppkey AS STRING))", "vendor"),
    ("'EA'", "stock_uom"),
    ("CASE WHEN l_suppkey % 2 = 1 AND l_partkey % 17 = 0 THEN 'CA' ELSE 'BX' END", "default_buy_uom"),
    ("CAST(CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 23 = 0 AND l_suppkey % 2 = 1 THEN NULL "
     "ELSE l_partkey % 5 + 1 END AS DOUBLE)", "buy_uom_multiplier"),
    ("CAST(CASE WHEN l_linenumber = 3 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS DOUBLE)", "available_qty"),
    ("CAST(l_linenumber AS DOUBLE)", "on_order_qty"),
    ("l_shipdate", "update_stamp"),
    ("l_shipdate", "report_stamp"),
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("l_extendedprice", "l_extendedprice"),
))

# Daily issue (usage) transactions.
USAGE = View("events", (
    ("CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END", "location"),
    ("concat('I', CAST(user_id * 10 + event_id % 10 AS STRING))", "item"),
    ("CAST(CASE WHEN user_id % 13 = 0 THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS DOUBLE)", "qty"),
    ("ts", "trx_date"),
))

# Long descriptions.
DESCRIPTION = View("part", (
    ("concat('I', CAST(p_partkey AS STRING))", "item"),
    ("p_name", "description3"),
))

# Substitute links.
ITEM_LINK = View("part", (
    ("concat('G', CAST(p_partkey - p_partkey % 20 AS STRING))", "item_group"),
    ("CASE WHEN p_partkey % 47 = 0 THEN NULL ELSE concat('I', CAST(p_partkey - p_partkey % 2 AS STRING)) END", "item"),
    ("concat('I', CAST(p_partkey + 2 AS STRING))", "replace_item"),
    ("CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_type END", "stage"),
))

# Rolling group usage per location. Parts whose number ends in 80..99 report
# under an 'H' group nobody links to, so some linked groups have no usage.
GROUP_USAGE = View("part", (
    ("CASE WHEN p_partkey % 100 >= 80 THEN concat('H', CAST(p_partkey - p_partkey % 20 AS STRING)) "
     "ELSE concat('G', CAST(p_partkey - p_partkey % 20 AS STRING)) END", "item_group"),
    ("CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END", "location"),
    ("CAST(CASE WHEN p_partkey % 100 < 20 THEN 0 ELSE p_partkey % 9 END AS DOUBLE)", "rolling_daily_avg_7"),
))

# Mail attachments that carried a feed file.
ARRIVALS = View("events", (
    ("event_id", "message_id"),
    ("concat('feed', CAST(user_id % 20 AS STRING))", "feed"),
    ("event_type", "subject"),
    ("CASE WHEN event_id % 5 = 0 THEN 'archive' ELSE 'inbox' END", "folder"),
    ("'file'", "attachment_type"),
    ("concat(CASE WHEN event_id % 3 = 0 THEN 'Shortage_' ELSE 'other_' END, CAST(event_id AS STRING), "
     "CASE WHEN event_id % 4 = 0 THEN '.csv' ELSE '.XLSX' END)", "file_name"),
    ("ts", "received_at"),
    ("CAST(0 AS INT)", "attachment_pos"),
))

VIEWS = {
    "fx_feed": FEED,
    "fx_inventory": INVENTORY,
    "fx_usage": USAGE,
    "fx_description": DESCRIPTION,
    "fx_item_link": ITEM_LINK,
    "fx_group_usage": GROUP_USAGE,
    "fx_arrivals": ARRIVALS,
}


def with_clause(*names: str) -> str:
    """``WITH`` prefix defining the named views for the DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS (\n{VIEWS[n].sql()}\n)" for n in names) + "\n"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name].spark(spark, sf_dir)


# Fixed parameters of the fixtures (never read the clock).
COVERAGE_AS_OF = datetime(1998, 6, 15, 11, 30, 0)     # not midnight: floors partial days
USAGE_AS_OF = datetime(2024, 1, 25, 0, 0, 0)     # events before and after the window
USAGE_WINDOW_DAYS = 14
USAGE_DIVISOR = 365
FRESHNESS_AS_OF = datetime(2001, 11, 1, 0, 0, 0)
FRESHNESS_DAYS = 10
ARRIVALS_AS_OF = datetime(2024, 1, 31, 0, 0, 0)
ARRIVALS_LOOKBACK_HOURS = 48
ARRIVALS_MAX_MESSAGES = 100
ARRIVALS_KEYWORD = "view"
ARRIVALS_PREFIX = "shortage"
ARRIVALS_FALLBACK_FOLDER = "archive"
RETENTION_AS_OF = datetime(2000, 5, 5)
RETENTION_DAY_RANGE = (3, 10)
RISK_LEVELS = ("HIGH", "URGENT")
DURATION_THRESHOLD = 30.0
LOCATIONS = ("A", "B")
SECONDARY_LOCATION = "B"
EXCLUDED_STAGES = ("PROMO", "SMALL")
REVIEW_THRESHOLD = -10.0
LABEL_TOKEN = "_"
