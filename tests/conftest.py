import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from cosecha.session import tune
    ck = tempfile.mkdtemp(prefix="cosecha-test-ckpt-")
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ck)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    tune(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return SF["0.01"]


@pytest.fixture(scope="session")
def sf0001():
    return SF["0.001"]
