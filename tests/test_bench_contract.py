"""bench.py prints one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4", BENCH_REPEAT="1")
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True, timeout=2400, env=env
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "headline_total_sec" and d["unit"] == "sec" and d["sf"] == 0.001
    assert d["errors"] == {} and d["value"] > 0
    import __spark_entry__ as entry

    assert set(d["queries"]) == set(entry.queries())
