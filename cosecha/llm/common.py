"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha.session import checkpoint_dir, scratch_path, ship_package

#: Rows and bytes of one Arrow batch sent to a Python worker: bounds what a
#: worker holds at once when texts are long.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # tables of this subpackage have rows of up to a mebibyte and more
    "spark.sql.parquet.columnarReaderBatchSize": "128",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim  # noqa: B018
except (OSError, AttributeError):  # another C library: nothing to trim
    _LIBC = None


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session ready: package shipped to the workers, shared scratch
    folder known, Arrow batches bounded."""
    for k, v in ARROW_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)
    checkpoint_dir(spark)
    return spark


def store(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in a fresh folder of the shared checkpoint
    folder and read it back: computed once, lineage cut, safe to lose
    executors after."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now, and
    not at its next periodic collection: a job of several large steps would hold
    the files of all of them until then."""
    for _ in range(2):  # the first frees what only Python held, the second what that held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def trim() -> None:
    """In a Python worker: give freed memory back to the system between large
    rows, so that two workers and the JVM fit an executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def batches(it: Iterable[pa.RecordBatch], columns: dict[str, list], schema: pa.Schema,
            rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Not a generator of its own: turn column lists into record batches of at
    most ``rows`` rows."""
    n = len(next(iter(columns.values())))
    for a in range(0, n, rows):
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name][a:a + rows], f.type) for f in schema], schema=schema)


def null_safe_anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` without an equal (null = null) key row in ``right``."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left_anti")
