"""K3 / A10 -- run audit row and run counters.

In the job the counters come from what has been written (the stored feed and the
report partition), so they are exact; as a lazy query they are one aggregate per
frame. The audit row is a one-row DataFrame appended to the audit table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions import ts_lit

# The audit table's columns and run statuses.
AUDIT_COLUMNS = (
    "process_name", "process_id", "source_file_path", "last_run_time", "target_table_name",
    "task_status", "row_count", "duration", "package_path", "log_file_path", "stg_table_name",
    "process_frequency", "error",
)
STATUSES = ("SUCCESS", "FAIL", "TIMEOUT")


def run_counters(feed: DataFrame, report: DataFrame) -> DataFrame:
    """A10: feed rows (after dedup), risk-selected rows and report rows."""
    f = feed.agg(F.count(F.lit(1)).cast("bigint").alias("feed_rows"),
                 F.count(F.when(F.col("risk_selected") == "x", 1)).cast("bigint").alias("selected_rows"))
    r = report.agg(F.count(F.lit(1)).cast("bigint").alias("output_rows"))
    return f.crossJoin(r)


def feed_counters(feed: DataFrame) -> dict:
    """A10 of the feed as stored (once, exact: re-run tasks cannot count twice)."""
    return feed.agg(F.count(F.lit(1)).alias("feed_rows"),
                    F.count(F.when(F.col("risk_selected") == "x", 1)).alias("selected_rows")).first().asDict()


def counters_frame(spark, values: dict) -> DataFrame:
    """One-row counters DataFrame from three numbers."""
    return spark.range(1).select(*[F.lit(int(values.get(k, 0))).cast("bigint").alias(k)
                                   for k in ("feed_rows", "selected_rows", "output_rows")])


def audit_row(counters: DataFrame, *, process_name: str, process_id: str, source_file_path: str | None,
              last_run_time: datetime, task_status: str, duration_seconds: float,
              package_path: str, log_file_path: str | None, process_frequency: str,
              error: str = "") -> DataFrame:
    """K3: one audit row; ``row_count`` = feed rows after dedup, duration in
    whole seconds (truncated), NULL paths become ''."""
    if task_status not in STATUSES:
        raise ValueError(f"unknown status {task_status!r}")
    return counters.select(
        F.lit(process_name).alias("process_name"),
        F.lit(process_id).alias("process_id"),
        F.lit(source_file_path or "").alias("source_file_path"),
        ts_lit(last_run_time).alias("last_run_time"),
        F.lit("Not Applicable").alias("target_table_name"),
        F.lit(task_status).alias("task_status"),
        F.col("feed_rows").alias("row_count"),
        F.lit(int(duration_seconds)).cast("int").alias("duration"),
        F.lit(package_path).alias("package_path"),
        F.lit(log_file_path or "").alias("log_file_path"),
        F.lit("Not Applicable").alias("stg_table_name"),
        F.lit(process_frequency).alias("process_frequency"),
        F.lit(error).alias("error"),
    )


def append_audit(row: DataFrame, path: str, fmt: str = "parquet") -> None:
    row.write.mode("append").format(fmt).save(path)
