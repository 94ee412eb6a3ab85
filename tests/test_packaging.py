"""Task-side Python code must run when the driver starts outside the repository."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, '__spark_entry__.py')!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", E.queries()["archive_ingest"](spark, "/root/testdata/sf0.001").count())
"""


def test_mapinpandas_queries_run_from_foreign_working_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 6000" in out.stdout, out.stderr[-2000:]
