"""Feed arrivals as an incremental file source.

The landing folder is a Structured Streaming file source; every poll is an ``availableNow`` run, so it
ends at a batch boundary and never inside a job. The stream's checkpoint keeps which files have been seen, and
``foreachBatch`` runs the batch job on every file of the micro-batch, oldest first. The stream carries file names
only; the feed itself is read by header name.

A ledger table beside the outputs gets one row per finished run (SUCCESS, FAIL or TIMEOUT). A micro-batch that is
replayed after a crash skips the files that the ledger has, and a file without a ledger row starts on an
empty output folder: every file has one run, one report and one audit row. A file that fails is recorded and the files
behind it go on.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.plans.job import Params, run_job
from shortfall.session import drop_folder, folder_exists
from shortfall.sources import read_feed

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
LEDGER_SCHEMA = "path string, batch_id long, out_dir string, status string, error string, finished_at timestamp"


def arrival_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of landed files: (path, modificationTime)."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing_dir).select("path", "modificationTime")


def ledger_path(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/_arrivals/ledger"


def ledger(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per finished run of a feed file; no rows before the first one."""
    path = ledger_path(out_dir)
    if not folder_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _record(spark: SparkSession, out_dir: str, path: str, batch_id: int, out: str, status: str, error: str) -> None:
    row = spark.createDataFrame([(path, batch_id, out, status, error, datetime.now())], LEDGER_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(ledger_path(out_dir))


def default_checkpoint(landing_dir: str, out_dir: str) -> str:
    """A folder of its own for each pair of landing and output folder, beside the outputs."""
    return f"{out_dir.rstrip('/')}/_arrivals/checkpoint-{hashlib.sha256(landing_dir.encode()).hexdigest()[:16]}"


def _seconds(spark: SparkSession, interval: str) -> float:
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {interval})").first()[0] / 1e6


def run_on_arrivals(spark: SparkSession, landing_dir: str, inputs: Callable[[SparkSession], dict],
                    params: Params, out_dir: str, checkpoint_location: str | None = None,
                    fmt: str = "csv", every: str | None = None,
                    max_files_per_trigger: int | None = None, timeout_s: float | None = None,
                    run_timeout_s: float | None = None, attempts: int = 1, **job_kwargs) -> list[dict]:
    """Process every feed file that arrived since the last run, one job run per file.

    ``inputs(spark)`` returns the inventory-side DataFrames (the ``feed`` key
    is filled from the file). Each file has an output folder
    ``batch_<micro-batch>_<n>``, numbered by modification time, then name.
    Default: take what has landed, then stop (one scheduled run). ``every="1 hour"`` polls the
    landing folder until ``timeout_s`` is over; a poll that has begun is finished. ``run_timeout_s`` limits each job
    run (audited as TIMEOUT). A file that failed runs again in later polls until it has had ``attempts`` runs.
    An output folder serves one landing folder.
    """
    results: list[dict] = []

    def run_file(path: str, batch_id: int, out: str) -> None:
        status, error, res = "SUCCESS", "", {}
        try:
            data = dict(inputs(spark))
            data["feed"] = read_feed(spark, path, fmt)
            res = run_job(data, params, out, source_file_path=path, timeout_s=run_timeout_s, **job_kwargs)
        except Exception as exc:  # noqa: BLE001 - recorded; the files behind go on
            status, error = "TIMEOUT" if getattr(exc, "timed_out", False) else "FAIL", str(exc)
        _record(spark, out_dir, path, batch_id, out, status, error)
        results.append({"batch_id": batch_id, "source_file": path, "out_dir": out, **res, "status": status, **({"error": error} if error else {})})

    def process(batch: DataFrame, batch_id: int) -> None:
        files = batch.distinct().orderBy("modificationTime", "path").collect()      # names of one micro-batch's files
        done = {r["path"] for r in ledger(spark, out_dir).where(F.col("path").isin([f["path"] for f in files])).select("path").collect()}
        for n, file in enumerate(files):
            if file["path"] in done:
                continue
            out = f"{out_dir}/batch_{batch_id}_{n}"
            drop_folder(spark, out)                                                 # of a run that a crash cut off
            run_file(file["path"], batch_id, out)

    def poll() -> None:
        if attempts > 1:
            failed = ledger(spark, out_dir).groupBy("path").agg(F.count("*").alias("runs"), F.max(F.col("status") == "SUCCESS").alias("good"),
                                                               F.max_by("batch_id", "finished_at").alias("batch_id"), F.max_by("out_dir", "finished_at").alias("out"))
            for r in failed.where(~F.col("good") & (F.col("runs") < attempts)).orderBy("batch_id", "path").collect():
                run_file(r["path"], r["batch_id"], r["out"])
        (arrival_stream(spark, landing_dir, max_files_per_trigger).writeStream.foreachBatch(process)
         .option("checkpointLocation", checkpoint_location or default_checkpoint(landing_dir, out_dir))
         .trigger(availableNow=True).start().awaitTermination())

    if not every:
        poll()
        return results
    pause, end = _seconds(spark, every), None if timeout_s is None else time.monotonic() + timeout_s
    while True:
        began = time.monotonic()
        poll()
        now = time.monotonic()
        next_poll = max(now, began + pause)
        if end is not None and next_poll >= end:
            return results
        time.sleep(next_poll - now)
