import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
assert e.entry(s).count() > 0
assert e.queries()["p5_found"](s, "/root/testdata/sf0.001").count() > 0
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_workers_get_the_code(small_data, tmp_path):
    """From any folder, without the package on the workers' path."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, check=True, timeout=300)
