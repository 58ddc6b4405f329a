"""Diagnostics for plan reviews (no Spark UI needed).

    python -m shortfall.plans.diagnostics plans SF_DIR      # shuffles / joins per job stage
    python -m shortfall.plans.diagnostics events LOG_DIR    # SQL execution times from an event log

The event log is Spark's own (``spark.eventLog.enabled=true``,
``spark.eventLog.dir=<scratch folder>``).
"""

from __future__ import annotations

import glob
import io
import json
import re
import sys

STAGES = ("feed", "latest_inventory", "reconciled_inventory", "reconciled_usage", "feed_with_substitutes",
          "full", "conversion_tuples", "conversions", "review", "report")


def plan_counts(plan: str) -> dict[str, int]:
    def n(pattern: str) -> int:
        return len(re.findall(pattern, plan))
    return {
        "shuffles": n(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)"),
        "sort_merge_joins": n(r"SortMergeJoin"),
        "broadcast_joins": n(r"BroadcastHashJoin"),
        "nested_loop_joins": n(r"BroadcastNestedLoopJoin"),
        "windows": n(r"\bWindow \["),
        "python": n(r"(BatchEvalPython|ArrowEvalPython)"),
    }


def review_plans(sf_dir: str) -> list[tuple[str, dict[str, int]]]:
    """Plan counts of every job stage, each planned against its pinned inputs."""
    from shortfall.plans import catalogue as CAT
    from shortfall.plans.job import build_stages
    from shortfall.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    st = build_stages(CAT.inputs(spark, sf_dir), CAT.PARAMS)
    out = []
    for name in STAGES:
        df = getattr(st, f"_build_{name}")()
        out.append((name, plan_counts(df._jdf.queryExecution().executedPlan().toString())))
        st[name]
    st.release()
    return out


def event_summary(log_dir: str) -> list[tuple[int, int, str]]:
    """(execution id, duration ms, description) of every SQL execution."""
    events = []
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/local-*")):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        events += [json.loads(line) for line in raw.decode().splitlines() if line]
    start, out = {}, []
    for e in events:
        if e["Event"].endswith("SQLExecutionStart"):
            start[e["executionId"]] = (e["time"], e.get("description", "")[:60])
        elif e["Event"].endswith("SQLExecutionEnd") and e["executionId"] in start:
            t, d = start[e["executionId"]]
            out.append((e["executionId"], e["time"] - t, d))
    return out


def main(argv: list[str]) -> None:
    if len(argv) != 2 or argv[0] not in ("plans", "events"):
        print(__doc__)
        return
    if argv[0] == "plans":
        for name, c in review_plans(argv[1]):
            print(f"{name:24s} " + " ".join(f"{k}={v}" for k, v in c.items()))
    else:
        rows = event_summary(argv[1])
        for i, ms, d in rows:
            print(f"{i:5d} {ms:8d} ms  {d}")
        print(f"total {sum(ms for _, ms, _ in rows)} ms over {len(rows)} executions")


if __name__ == "__main__":
    main(sys.argv[1:])
