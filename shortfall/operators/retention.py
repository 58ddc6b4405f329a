"""K4 / K5 -- monthly retention on tables.

Rows stamped strictly before the first day of the ``as_of`` month are archived
(K4) or purged (K5). Both run only when the day of month lies in an inclusive
range; a closed gate moves nothing. One task failing does not stop the other.

A table partitioned by its date is archived by whole partitions (:func:`move_partitions`): the folders before the
month change their place, everything else keeps its files. Other tables are rewritten, and only if a row goes.
"""

from __future__ import annotations

import logging
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.functions import ts_lit
from shortfall.session import child_folders, has_data_files, move_folder, move_mark, reads_from, replace_folder

log = logging.getLogger("shortfall.retention")


def gate_open(as_of: date | datetime, day_range: tuple[int, int]) -> bool:
    lo, hi = day_range
    return lo <= as_of.day <= hi


def month_start(as_of: date | datetime) -> datetime:
    return datetime(as_of.year, as_of.month, 1)


def retention_split(df: DataFrame, ts_col: str, as_of: date | datetime,
                    day_range: tuple[int, int]) -> DataFrame:
    """K4: tag every row ``archive`` (before the month start, gate open) or
    ``active``."""
    if not gate_open(as_of, day_range):
        return df.withColumn("retention", F.lit("active"))
    old = F.col(ts_col) < ts_lit(month_start(as_of))
    return df.withColumn("retention", F.when(old, F.lit("archive")).otherwise(F.lit("active")))


def retention_purge(df: DataFrame, ts_col: str, as_of: date | datetime,
                    day_range: tuple[int, int]) -> DataFrame:
    """K5: rows kept after purging those before the month start (NULL stamps
    are kept, as a file without a time is never older than the cutoff)."""
    if not gate_open(as_of, day_range):
        return df
    # written as ">= cutoff OR IS NULL" so Parquet can take it as a pushed filter
    return df.filter((F.col(ts_col) >= ts_lit(month_start(as_of))) | F.col(ts_col).isNull())


def archive_rows(df: DataFrame, ts_col: str, as_of: date | datetime, day_range: tuple[int, int],
                 archive_path: str, active_path: str, fmt: str = "parquet",
                 partition_by: str | None = None) -> dict[str, int]:
    """K4 on tables: move the old rows to the growing archive, then replace the active table.

    The archive gets one partition ``archive_batch`` per distinct set of moved rows (named by month,
    row count and checksum). A repeated run writes the same partition again, any other
    run adds one, so earlier batches are never touched. The active table is replaced only after the
    archived rows have been counted; ``active_path`` may be the folder that ``df`` reads.
    Returns the rows archived and kept.
    """
    if reads_from(df, archive_path):
        raise ValueError(f"the table is read from its archive {archive_path!r}")
    tagged = retention_split(df, ts_col, as_of, day_range)
    old = tagged.filter(F.col("retention") == "archive").drop("retention")
    moved, mark = old.agg(F.count("*"), F.sum(F.xxhash64(*old.columns).cast("decimal(38,0)"))).first()
    if moved:
        batch = f"{archive_path.rstrip('/')}/archive_batch={month_start(as_of):%Y%m}-{moved}-{int(mark) % (1 << 64):016x}"
        old.write.mode("overwrite").format(fmt).save(batch)
        written = df.sparkSession.read.schema(old.schema).format(fmt).load(batch).count()
        if written != moved:
            raise RuntimeError(f"archived {written} rows of {moved}; the active table is left as it was")
    if not moved and reads_from(df, active_path):
        return {"archived": 0, "active": df.count()}                            # nothing goes, nothing is written
    kept = replace_folder(tagged.filter(F.col("retention") == "active").drop("retention"), active_path, fmt, partition_by)
    return {"archived": moved, "active": kept}


def move_partitions(spark: SparkSession, active_path: str, archive_path: str, partition_by: str, as_of: date | datetime,
                    day_range: tuple[int, int]) -> dict[str, int]:
    """K4 on a table partitioned by a date column: move the partitions before the month to the archive, which has the same
    layout. Rows without a date stay. Returns the rows archived and kept (both from file footers).

    A mark beside the archive says that a move is under way and which month it is for. A run that stopped on the way is
    finished by the next one, whatever its own month and gate: each partition is in one of the two
    places, and a partition that the archive has already gets the late files added to it.
    """
    mark = f"{archive_path.rstrip('/')}/_moving"
    pending = move_mark(spark, mark)
    if pending is None and not gate_open(as_of, day_range):
        return {"archived": 0, "active": _rows(spark, active_path)}
    limits = [x for x in (pending, f"{month_start(as_of):%Y-%m-%d}" if gate_open(as_of, day_range) else None) if x]
    old = []
    for folder in child_folders(spark, active_path):
        name = folder.rstrip("/").rsplit("/", 1)[1]
        if name.startswith(f"{partition_by}=") and name.split("=", 1)[1][:10] < max(limits) and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            old.append(name)
    if old:
        move_mark(spark, mark, max(limits))
        moved = sum(_rows(spark, f"{active_path}/{name}") for name in old)
        for name in old:
            move_folder(spark, f"{active_path}/{name}", f"{archive_path}/{name}")
    else:
        moved = 0
    if old or pending:
        move_mark(spark, mark, "")
    return {"archived": moved, "active": _rows(spark, active_path)}


def _rows(spark: SparkSession, path: str) -> int:
    """Rows of a table folder, 0 if it has no files."""
    return spark.read.parquet(path).count() if has_data_files(spark, path) else 0


def purge_rows(df: DataFrame, ts_col: str, as_of: date | datetime, day_range: tuple[int, int],
               path: str, fmt: str = "parquet") -> dict[str, int]:
    """K5 on tables: replace the table in ``path`` by the rows that stay; counts both."""
    before = df.count()
    if reads_from(df, path) and retention_purge(df, ts_col, as_of, day_range).count() == before:
        return {"removed": 0, "kept": before}                                   # nothing goes, nothing is written
    kept = replace_folder(retention_purge(df, ts_col, as_of, day_range), path, fmt)
    return {"removed": before - kept, "kept": kept}


def run_maintenance(audit: DataFrame, audit_ts: str, audit_out: str,
                    outputs: DataFrame, outputs_ts: str, archive_path: str, active_path: str,
                    as_of: date | datetime, day_range: tuple[int, int], fmt: str = "parquet",
                    partition_by: str | None = None) -> dict:
    """Monthly maintenance: purge old audit rows (K5) and archive old report
    rows (K4). Runs only inside the day-of-month gate; each task reports its
    counts, or its own failure without stopping the other."""
    if not gate_open(as_of, day_range):
        return {"gate": "closed"}
    result: dict = {"gate": "open"}
    tasks = {
        "purge": lambda: purge_rows(audit, audit_ts, as_of, day_range, audit_out, fmt),
        "archive": lambda: archive_rows(outputs, outputs_ts, as_of, day_range, archive_path, active_path, fmt, partition_by),
    }
    for name, task in tasks.items():
        try:
            result[name] = task()
        except Exception as exc:  # noqa: BLE001 - maintenance keeps going
            log.exception("maintenance task %s failed", name)
            result[name] = f"failed: {exc}"
    return result
