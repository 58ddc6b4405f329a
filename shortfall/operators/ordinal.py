"""Order-dependent operators, written so that no key is funnelled into one task.

* ``latest_per_key`` -- newest row per key as a filtered ``row_number``. Spark's
  group limit keeps one row per key and map task before the shuffle, so
  a key holding a third of all rows still ships one row per map partition.
* ``sequence`` -- dense 1..n numbering in an explicit total order without a
  single-partition window: range-partition on the order, store each row's
  partition id and position with the rows, count rows per partition, add the
  running offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortfall.session import pin


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str | Column]) -> DataFrame:
    """Keep one row per ``keys``: the row that sorts first under
    ``ORDER BY order_desc[0] DESC NULLS LAST, order_desc[1] DESC NULLS LAST, ...``.

    A filtered ``row_number``: Spark limits every group to one row per map task
    before the shuffle (``WindowGroupLimit``), so a hot key ships one row per task.
    ``order_desc`` must make the order total for the result to be deterministic.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order_desc]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", first).filter(F.col("_rank") == 1).select(*df.columns)


def sequence(df: DataFrame, order_by: Sequence[Column | str], name: str = "row_id",
             start: int = 1, partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """Add ``name`` = 1..n (plus ``start - 1``) following ``order_by``.

    ``order_by`` must be a total order (ties would be numbered arbitrarily).
    Rows are range-partitioned on the order and sorted within partitions; the
    pass that writes them as Parquet (under the checkpoint folder) also
    stores each row's partition id and position. Those stored values fix the
    numbering however the file is split when read back, and a retried task
    recomputes the same partition (same range bounds, total order). Only the
    per-partition counts (one row per partition) are broadcast back; nothing
    is collected.
    """
    spark = df.sparkSession
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    # Without an explicit count AQE may merge adjacent range partitions to
    # fit the data; merged ranges stay contiguous, so the order holds.
    ranged = (df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)) \
        .sortWithinPartitions(*cols)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id())
    stored = pin(tagged, f"sequence-{name}", folder)
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    # one row per partition: the window and the broadcast are bounded by the
    # partition count, not by the data
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    out = stored.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(name, (F.col("_off") + (F.col("_mid") - F.col("_first")) + F.lit(start)).cast("bigint"))
    return out.drop("_pid", "_mid", "_first", "_off")
