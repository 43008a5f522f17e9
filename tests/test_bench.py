"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "--no-stream", "--no-scaling", "--no-corpus"],
                         capture_output=True, text=True, env=env, timeout=900, cwd=REPO)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["value"] > 0 and d["sf"] == 0.001
    assert set(d["queries"]) >= {"task_statistics_per_machine", "job_scheduling_latency", "busy_machines"}
