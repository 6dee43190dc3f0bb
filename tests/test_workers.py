"""Python-side functions must run on workers that do not have the package on their path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from metrolens.catalog import QUERIES
n = QUERIES["bucket_udf"](spark, "/root/testdata/sf0.001").filter("time_of_day IS NOT NULL").count()
m = QUERIES["geojson_features"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n, m)
spark.stop()
"""


def test_udfs_run_outside_the_repo(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert "ROWS" in out.stdout, out.stderr[-3000:]
    n, m = map(int, out.stdout.split("ROWS")[1].split())
    assert n > 0 and m > 0
