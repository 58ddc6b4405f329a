"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregates and joins by node, written to the shared
checkpoint folder; nothing but a row count and a checksum goes to the driver.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.session import pin, pin_folder


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of written stages: it acts when the driver
    collects garbage, which a mostly idle driver does too seldom for a small disk."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - no JVM handle (Spark Connect): the cluster cleans up by itself
        pass


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).select(F.col("a").alias("u"), "m")
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to its smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    joined = down.join(least, F.col("a") == F.col("u")).select("b", "m").where("b <> m")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges (a, b)``; the component is its smallest node.

    Loops, repeated edges and rows with NULL are ignored; no edges give no rows.
    """
    folder = pin_folder(edges.sparkSession)
    state = pin(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct(), "edges", folder)
    seen, k = None, 0
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == seen:
            break
        seen, k = mark, k + 1
        state = pin(_small_star(_large_star(state)), f"round{k}", folder)
    stars = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(state.select(F.col("b"), F.col("b")).distinct())
