"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="transitions,densify")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    lines = [x for x in out if x.startswith("{")]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"transitions", "densify"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
