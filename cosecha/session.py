"""Session helpers: a tuned SparkSession and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every flow relies on. They are session-level and safe to
# set on a session someone else built (the driver's, a notebook's).
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (UDFs, the XPORT data
    source) whatever the driver's working directory: zip it once per driver
    process and ``addPyFile`` it, which also distributes it to executors."""
    try:
        sc = spark.sparkContext
        key = id(sc._jsc)
    except Exception:  # noqa: BLE001 - no driver-side context (e.g. Spark Connect)
        return
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="cosecha-pyfiles-"), "cosecha.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cosecha") -> SparkSession:
    """Build (or reuse) a session. On a cluster pass master=None and let
    spark-submit decide; locally we default to all cores."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.driver.memory", os.environ.get("COSECHA_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator (HDFS/S3/...). Only when it is
    unset (local runs, tests) do we create one of our own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "local").startswith("local") or \
                spark.conf.get("spark.master", "local").startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cosecha-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - no driver-side context (e.g. Spark Connect)
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "table"):
    """Compute ``df`` once and cut its lineage: written as a Parquet table in a
    fresh folder under the shared ``spark.checkpoint.dir`` and read back
    (never a machine-local folder; a lost executor only costs a re-read).

    Used where one intermediate feeds several branches of a plan, so the
    upstream scan/aggregate is not re-run per branch or per scalar subquery.
    Unlike ``DataFrame.checkpoint()`` (which recomputes its input once more
    to save it) this computes the plan a single time, and the read-back scan
    gets column pruning, filter push-down and real size statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
