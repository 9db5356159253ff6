"""The bench's headline queries exist and its output is one JSON line."""

import json
import os
import subprocess
import sys

import bench
from idweave.plans.catalog import QUERIES


def test_headline_queries_registered():
    assert set(bench.HEADLINE) <= set(QUERIES)


def test_bench_prints_one_json_line():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="clean_phone,count_by_type",
               BENCH_CPUS="2")
    out = subprocess.run([sys.executable, "bench.py"], cwd=root, env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["metric"] and d["unit"] == "sec" and set(d["queries"]) == {"clean_phone", "count_by_type"}
    assert d["sf"] == 0.001
