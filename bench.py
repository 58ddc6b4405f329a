"""Benchmark: time the headline queries on ``$BENCH_SF_DIR`` with
``local[$BENCH_CPUS]`` and print one JSON line.

Each query is fully executed through the ``noop`` sink (every row computed,
nothing collected to the driver). ``end_to_end_job`` runs the whole job with
its real sinks (report, side output, audit row) into a scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shortfall.plans import catalogue as CAT  # noqa: E402
from shortfall.plans.job import run_job  # noqa: E402
from shortfall.session import build_session, drop_folder, list_pin_folders  # noqa: E402

HEADLINE = (
    "latest_inventory", "avg_daily_issue", "reconciled_inventory", "enriched_inventory", "substitutes",
    "coverage_metrics", "group_coverage", "recommendations", "packaging_parse", "uom_conversions",
    "uom_alternatives", "latest_arrival", "final_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="shortfall-bench", shuffle_partitions=max(cpus, 4),
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    # warm-up: JVM class loading and the first parquet footer reads
    CAT.QUERIES["item_description"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        before = list_pin_folders(spark)
        t0 = time.perf_counter()
        CAT.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        for folder in list_pin_folders(spark) - before:   # the query's scratch stages
            drop_folder(spark, folder)
    out_dir = tempfile.mkdtemp(prefix="shortfall-bench-")
    t0 = time.perf_counter()
    run_job(CAT.inputs(spark, sf_dir), CAT.PARAMS, out_dir, process_frequency="weekly")
    times["end_to_end_job"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
