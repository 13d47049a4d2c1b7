"""The benchmark runs and prints its line."""

import json
import os
import pathlib
import subprocess
import sys


def test_bench_prints_one_line(sf_dir):
    root = pathlib.Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, "bench.py", "row_count", "ml_predict"],
        cwd=root, env={**os.environ, "BENCH_SF_DIR": sf_dir, "BENCH_CPUS": "4"}, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    line = json.loads(done.stdout.strip().splitlines()[-1])
    assert set(line["queries"]) == {"row_count", "ml_predict"} and line["sf"] == "0.001" and line["value"] > 0
