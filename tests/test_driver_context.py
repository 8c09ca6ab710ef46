"""The entry module works from another working directory with a plain
session (Python workers must import the package: it is shipped to them)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
assert E.entry(spark).count() > 0
assert E.queries()["src_xport"](spark, "/root/testdata/sf0.001").count() == 200
assert E.queries()["fuzzy_best_match"](spark, "/root/testdata/sf0.001").count() > 0
print("DRIVER-OK")
"""


def test_entry_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="drv-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "DRIVER-OK" in out.stdout, out.stderr[-3000:]
