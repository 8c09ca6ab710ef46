"""Round-trip queries for the sources and sinks: driver tables are written
by Spark into fresh folders under the shared checkpoint folder (CSV, zipped
CSV, XPORT, zipped XPORT, Parquet stores) and scanned back, so each query's
work grows with the tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha import adapters as A
from cosecha.functions.text import table_name
from cosecha.session import scratch_path
from cosecha.sources import archive
from cosecha.sources.files import ingest, read_csv
from cosecha.sources.tables import concurrently, copy_all, list_tables, row_counts, scan_table, write_replace
from cosecha.sources.xport import list_files, read_xport, write_xport

# part with XPORT-legal (<= 8 character) names
PART_XPT = {"p_partkey": "PARTKEY", "p_name": "NAME", "p_brand": "BRAND", "p_type": "TYPE",
            "p_size": "SIZE", "p_retailprice": "RETAILPR"}


def _part(spark, d):
    return A.table(spark, d, "part")


def _zip_csv_partitions(df: DataFrame, dest: str, member: str) -> None:
    """Each partition -> one archive holding one CSV member with a header,
    written batch by batch."""
    columns = list(df.columns)

    def run(batches):
        import zipfile
        from pyspark import TaskContext
        from cosecha.sources.xport import _fs
        pid = TaskContext.get().partitionId()
        target = f"{dest.rstrip('/')}/part-{pid:05d}.zip"
        fs, p = _fs(target)
        fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(p) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z, \
                z.open(member, "w", force_zip64=True) as out:
            out.write(pd.DataFrame(columns=columns).to_csv(index=False).encode("utf-8"))
            for pdf in batches:
                out.write(pdf.to_csv(index=False, header=False).encode("utf-8"))
        yield pd.DataFrame({"archive": [target]})
    df.mapInPandas(run, "archive string").collect()


def q_src_csv(spark: SparkSession, d: str) -> DataFrame:
    part = _part(spark, d)
    path = scratch_path(spark, "csv")
    part.write.option("header", True).csv(path)
    return read_csv(spark, path, part.schema)


def q_src_zip_csv(spark: SparkSession, d: str) -> DataFrame:
    part = _part(spark, d)
    zips = scratch_path(spark, "zipcsv")
    _zip_csv_partitions(part, zips, "part.csv")
    files = [r.path for r in archive.unpack(spark, zips, scratch_path(spark, "unzipped"),
                                            members=["part.csv"]).collect()]
    return read_csv(spark, files, part.schema)


def _write_part_xport(spark, d) -> str:
    part = _part(spark, d).select(*[F.col(k).alias(v) for k, v in PART_XPT.items()])
    path = scratch_path(spark, "xpt")
    write_xport(part, path, member="PART")
    return path


def q_src_xport(spark: SparkSession, d: str) -> DataFrame:
    return read_xport(spark, _write_part_xport(spark, d))


def q_src_zip_xport(spark: SparkSession, d: str) -> DataFrame:
    xpt = _write_part_xport(spark, d)
    zips = archive.zip_files(spark, list_files(xpt), scratch_path(spark, "zipxpt"),
                             member_name=lambda f: f.rsplit("/", 1)[-1].upper() + "  ")
    out = scratch_path(spark, "unzipxpt")
    files = [r.path for r in archive.unpack(spark, zips, out, xpt_first=True).collect()]
    return read_xport(spark, out if files else files)


def q_sink_replace(spark: SparkSession, d: str) -> DataFrame:
    """A table replaced by another one, clustered on three of its columns."""
    store = scratch_path(spark, "store")
    write_replace(A.table(spark, d, "customer"), store, "orders")  # first content ...
    write_replace(A.table(spark, d, "orders"), store, "orders",    # ... fully replaced
                  cluster_by=["o_orderkey", "o_custkey", "o_orderpriority"])
    return scan_table(spark, store, "orders")


def _whole_store(spark, d) -> str:
    """Every given table in a store of its own."""
    store = scratch_path(spark, "store")
    concurrently(lambda t: write_replace(A.table(spark, d, t), store, t), A.BASE_TABLES)
    return store


def q_list_tables(spark: SparkSession, d: str) -> DataFrame:
    return list_tables(spark, _whole_store(spark, d))


def q_copy_all(spark: SparkSession, d: str) -> DataFrame:
    src = _whole_store(spark, d)
    dst = scratch_path(spark, "copy")
    names = copy_all(spark, src, dst)
    return row_counts(spark, dst, names)


def q_ingest_report(spark: SparkSession, d: str) -> DataFrame:
    """Every source kind: two CSV tables (one with a tolerant column list), a
    transport file, a zipped transport file, a zipped CSV bundle with an absent
    member, a missing file. Names come from the file names by rule."""
    work = scratch_path(spark, "ingest")

    def csv(t):
        A.table(spark, d, t).write.option("header", True).csv(f"{work}/csv/{t}")
        return f"{work}/csv/{t}"

    def xpt(t, **cols):
        write_xport(A.table(spark, d, t).select(*[F.col(c).alias(n) for n, c in cols.items()]).repartition(3),
                    f"{work}/xpt/{t}", member=t.upper()[:8])
        return f"{work}/xpt/{t}"

    # several files or archives a source, as large ones have
    A.table(spark, d, "part").repartition(3).write.option("header", True).csv(f"{work}/csv/part")
    archive.zip_files(spark, list_files(f"{work}/csv/part", ".csv"), f"{work}/zip/csv", member_name=lambda f: "food.csv")
    customer = xpt("customer", C_KEY="c_custkey", C_BAL="c_acctbal", C_SEG="c_mktsegment")
    orders = xpt("orders", O_KEY="o_orderkey", O_PRICE="o_totalprice", O_STAT="o_orderstatus")
    archive.zip_files(spark, list_files(orders), f"{work}/zip/xpt", member_name=lambda f: "LLCP.XPT ")
    manifest = [
        {"name": table_name("orders.csv", "ODEPA_"), "format": "csv", "path": csv("orders")},
        {"name": table_name("customer.csv"), "format": "csv", "path": csv("customer"),
         "columns": ["c_custkey", "c_name", "c_comment_x"]},
        {"name": "CUSTOMER_XPT", "format": "xport", "path": customer},
        {"name": "ORDERS_XPT", "format": "zip_xport", "path": f"{work}/zip/xpt", "columns": ["O_KEY", "O_STAT", "_STATE"]},
        {"format": "zip_csv", "path": f"{work}/zip/csv", "members": ["food.csv", "nutrient.csv"], "prefix": "FDC_"},
        {"name": table_name("no_such_file.csv", "FDC_"), "format": "csv", "path": f"{work}/no_such_file.csv"},
    ]
    return ingest(spark, manifest, f"{work}/store", f"{work}/scratch")


ORACLE_SOURCES = {
    "src_csv": "SELECT * FROM part",
    "src_zip_csv": "SELECT * FROM part",
    "src_xport": ("SELECT CAST(p_partkey AS DOUBLE) AS PARTKEY, p_name AS NAME, p_brand AS BRAND, "
                  "p_type AS TYPE, CAST(p_size AS DOUBLE) AS SIZE, p_retailprice AS RETAILPR FROM part"),
    "src_zip_xport": ("SELECT CAST(p_partkey AS DOUBLE) AS PARTKEY, p_name AS NAME, p_brand AS BRAND, "
                      "p_type AS TYPE, CAST(p_size AS DOUBLE) AS SIZE, p_retailprice AS RETAILPR FROM part"),
    "sink_replace": "SELECT * FROM orders",
    "list_tables": " UNION ALL ".join(f"SELECT '{t}' AS table_name" for t in A.BASE_TABLES),
    "copy_all": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in A.BASE_TABLES),
    "ingest_report": (
        "SELECT 'ODEPA_ORDERS' AS table_name, 'ok' AS status, count(*) AS n_rows, "
        "(SELECT count(*) FROM (DESCRIBE orders)) AS n_cols, CAST(NULL AS VARCHAR) AS error FROM orders "
        "UNION ALL SELECT 'CUSTOMER', 'ok', count(*), 2, NULL FROM customer "
        "UNION ALL SELECT 'CUSTOMER_XPT', 'ok', count(*), 3, NULL FROM customer "
        "UNION ALL SELECT 'ORDERS_XPT', 'ok', count(*), 2, NULL FROM orders "
        "UNION ALL SELECT 'FDC_FOOD', 'ok', count(*), (SELECT count(*) FROM (DESCRIBE part)), NULL FROM part "
        "UNION ALL SELECT 'FDC_NUTRIENT', 'missing', NULL, NULL, NULL "
        "UNION ALL SELECT 'FDC_NO_SUCH_FILE', 'error', NULL, NULL, 'PATH_NOT_FOUND'"),
}
