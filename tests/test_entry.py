"""The driver's contract works from its file alone."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from tests.conftest import SF_SMALL

ROOT = Path(__file__).resolve().parents[1]


def test_workers_get_the_package(tmp_path):
    """With the driver's own path set and nothing else, queries with Python workers run."""
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("contract", {str(ROOT / "__spark_entry__.py")!r})
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
queries = contract.queries()
assert set(contract.oracle_sql()) <= set(queries)
name = "op10_repetition" if "op10_repetition" in queries else "zone_dim"
print("rows", queries[name](spark, {SF_SMALL!r}).count() > 0, contract.entry(spark).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=600)
    assert "rows True 5" in done.stdout, done.stderr[-2000:]
