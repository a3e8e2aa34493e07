"""bench.py prints one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="success_day,prior_badges_left,roc_auc")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
        text=True, timeout=600, cwd="/tmp",
    )
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and "failed" not in rec
    assert set(rec["queries"]) == {"success_day", "prior_badges_left", "roc_auc"}
    assert rec["value"] > 0
