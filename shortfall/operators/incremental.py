"""State that is maintained instead of recomputed.

* Latest rows: one row per key, merged with the rows that arrived since (:func:`merge_latest`). The newest stamp per key is
  a hash aggregate over one fixed-width value; only rows that carry it are looked at for ties. "Newest" is associative, so
  merging slice after slice, late rows included, gives the rows of the full scan.
* Daily usage: sums per location, item and day (:func:`daily_usage`). A window is the sum of its whole days plus the
  transactions of the days that its two ends cut (:func:`usage_from_days`).

:func:`maintain_latest` and :func:`maintain_daily_usage` keep such tables from a growing folder. The folder is a file
stream, so a run reads only files that it has not merged. Each micro-batch writes a folder of its number; a batch that is
replayed after a crash writes the same folder from the same predecessor, so nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.functions import ts_lit
from shortfall.session import child_folders, drop_folder, folder_exists


def merge_latest(state: DataFrame | None, rows: DataFrame, keys: Sequence[str], stamp: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The latest row per key of ``state`` (a former result, or None) and ``rows``, by ``stamp`` descending, NULLs last,
    then ``tie_break`` descending. The same rows as ``latest_per_key`` over all of them."""
    both = rows if state is None else state.select(*rows.columns).unionByName(rows)
    names = [f"_k{i}" for i in range(len(keys))]
    newest = both.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.max(stamp).alias("_newest"), F.count("*").alias("_rows"))
    same = reduce(lambda x, y: x & y, [both[k].eqNullSafe(newest[n]) for k, n in zip(keys, names)])
    survivors = both.join(newest, same & both[stamp].eqNullSafe(newest["_newest"]))
    single, several = survivors.where("_rows = 1"), survivors.where("_rows > 1")
    order = [F.col(c).desc_nulls_last() for c in tie_break]
    if order:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        several = several.withColumn("_rank", rank).where("_rank = 1")
    else:
        several = several.dropDuplicates(list(keys))
    return single.select(*rows.columns).unionByName(several.select(*rows.columns))


def daily_usage(usage: DataFrame) -> DataFrame:
    """(location, item, day, qty): summed quantity; NULL if a day has only NULL quantities."""
    return usage.groupBy("location", "item", F.to_date("trx_date").alias("day")).agg(F.sum("qty").alias("qty"))


def usage_from_days(days: DataFrame, usage: DataFrame, as_of: datetime, window_days: int = 366, divisor: int = 365) -> DataFrame:
    """Average daily issue over ``[as_of - window, as_of]`` from daily sums; ``usage`` is read for the cut days only
    (filters reach both scans). Several sums of one day add up."""
    lo = as_of - timedelta(days=window_days)
    midnight = lambda t: datetime(t.year, t.month, t.day)
    first = midnight(lo) if lo == midnight(lo) else midnight(lo) + timedelta(days=1)
    last = midnight(as_of)                                     # the day of as_of is cut unless it ends there
    if first > last:                                           # within one day
        cut = F.col("trx_date").between(ts_lit(lo), ts_lit(as_of))
        whole = days.where(F.lit(False))
    else:
        cut = ((F.col("trx_date") >= ts_lit(lo)) & (F.col("trx_date") < ts_lit(first))) | ((F.col("trx_date") >= ts_lit(last)) & (F.col("trx_date") <= ts_lit(as_of)))
        whole = days.where((F.col("day") >= F.lit(first.date())) & (F.col("day") < F.lit(last.date())))
    parts = whole.select("location", "item", "qty").unionByName(usage.where(cut).select("location", "item", "qty"))
    return parts.groupBy("location", "item").agg((F.sum("qty") / F.lit(float(divisor))).alias("avg_daily_issue"))


def _maintain(stream: DataFrame, checkpoint: str, process: Callable[[DataFrame, int], None]) -> None:
    stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _versions(spark: SparkSession, state_dir: str) -> list[int]:
    """Finished versions of a state table, ascending."""
    found = [int(f.rsplit("=", 1)[1]) for f in child_folders(spark, state_dir) if "/version=" in f]
    return sorted(v for v in found if folder_exists(spark, f"{state_dir}/version={v}/_SUCCESS"))


def read_latest(spark: SparkSession, state_dir: str) -> DataFrame | None:
    """The newest finished state, None before the first one."""
    versions = _versions(spark, state_dir)
    return spark.read.parquet(f"{state_dir}/version={versions[-1]}") if versions else None


def maintain_latest(history: DataFrame, state_dir: str, keys: Sequence[str], stamp: str, tie_break: Sequence[str] = (),
                    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame | None:
    """Merge what the file stream ``history`` has not given yet into the state under ``state_dir`` and return the state.
    ``prepare`` filters and types the rows (the same in every run)."""
    spark = history.sparkSession

    def process(batch: DataFrame, batch_id: int) -> None:
        before = [v for v in _versions(spark, state_dir) if v < batch_id]
        state = spark.read.parquet(f"{state_dir}/version={before[-1]}") if before else None
        merge_latest(state, prepare(batch), keys, stamp, tie_break).write.mode("overwrite").parquet(f"{state_dir}/version={batch_id}")
        for old in before[:-1]:                                # the predecessor stays for a replay and for readers
            drop_folder(spark, f"{state_dir}/version={old}")

    _maintain(history, f"{state_dir}/_checkpoint", process)
    return read_latest(spark, state_dir)


def maintain_daily_usage(usage: DataFrame, state_dir: str, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Add the daily sums of what the file stream ``usage`` has not given yet (a late transaction adds to its day) and
    return the table of daily sums, partitioned by day. A run writes its own sums only."""
    spark = usage.sparkSession

    def process(batch: DataFrame, batch_id: int) -> None:
        daily_usage(prepare(batch)).repartition("day").write.mode("overwrite").partitionBy("day").parquet(f"{state_dir}/sums/batch={batch_id}")

    _maintain(usage, f"{state_dir}/_checkpoint", process)
    return spark.read.schema("location string, item string, qty double, batch long, day date").parquet(f"{state_dir}/sums").drop("batch")
