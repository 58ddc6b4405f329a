"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2")
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                          text=True, timeout=900, check=True)
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out) >= {"metric", "value", "unit", "queries", "sf"}
    assert "end_to_end_job" in out["queries"] and abs(sum(out["queries"].values()) - out["value"]) < 0.01
