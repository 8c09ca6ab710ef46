"""Round trips for the sources and sinks."""

import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cosecha import adapters as A
from cosecha.sources import archive
from cosecha.sources.files import ingest, read_csv
from cosecha.sources.tables import copy_all, list_tables, row_counts, scan_table, write_replace
from cosecha.sources.xport import (double_to_ibm, ibm_to_double, list_files, read_layout, read_xport,
                                   write_xport)


def test_ibm_float_roundtrip_and_missing():
    x = np.array([0.0, 1.0, -1.5, 3.141592653589793, 1e-70, 1e70, 123456.789, -0.1, np.nan])
    back, miss = ibm_to_double(double_to_ibm(x))
    assert list(miss) == [False] * 8 + [True]
    assert list(back[:8]) == list(x[:8])


def test_xport_readable_by_pandas_and_back(spark, sf0001):
    part = A.table(spark, sf0001, "part").select(
        F.col("p_partkey").alias("PARTKEY"), F.col("p_name").alias("NAME"), F.col("p_retailprice").alias("PRICE"),
        F.when(F.col("p_size") > 25, None).otherwise(F.col("p_size")).alias("SIZE")).coalesce(1)
    d = tempfile.mkdtemp(prefix="xpt-")
    write_xport(part, d, member="PART")
    files = list_files(d)
    assert len(files) == 1
    pdf = pd.read_sas(files[0], format="xport", encoding="utf-8")
    exp = part.toPandas()
    assert list(pdf.columns) == ["PARTKEY", "NAME", "PRICE", "SIZE"]
    # pandas turns an all-zero IBM float (SAS's 0) into 16**-65; ours reads 0.0
    got_keys = np.where(np.abs(pdf["PARTKEY"].to_numpy()) < 1e-70, 0.0, pdf["PARTKEY"].to_numpy())
    assert np.array_equal(got_keys, exp["PARTKEY"].astype(float).to_numpy())
    assert list(pdf["NAME"]) == list(exp["NAME"])
    assert np.allclose(pdf["SIZE"].to_numpy(), exp["SIZE"].astype(float).to_numpy(), equal_nan=True, rtol=0)
    back = read_xport(spark, d).toPandas()
    assert back["PRICE"].tolist() == exp["PRICE"].tolist()
    assert back["SIZE"].isna().sum() == exp["SIZE"].isna().sum()
    # column selection decodes only the listed variables (any case)
    assert read_xport(spark, d, columns=["name", "PRICE"]).columns == ["NAME", "PRICE"]


def test_xport_partitions_by_record_ranges(spark, sf0001):
    d = tempfile.mkdtemp(prefix="xpt-")
    write_xport(A.table(spark, sf0001, "nation").select(F.col("n_nationkey").alias("K")).coalesce(1), d)
    layout = read_layout(list_files(d)[0])
    assert layout.n_records == 25 and layout.record_length == 8
    df = spark.read.format("xport").option("recordsPerPartition", 7).load(d)
    assert df.rdd.getNumPartitions() == 4
    assert sorted(r.K for r in df.collect()) == [float(i) for i in range(25)]


def test_zip_xport_member_rule(spark, sf0001):
    d = tempfile.mkdtemp(prefix="zx-")
    write_xport(A.table(spark, sf0001, "region").select(F.col("r_regionkey").alias("K")).coalesce(1), f"{d}/x")
    zips = archive.zip_files(spark, list_files(f"{d}/x"), f"{d}/z", member_name=lambda f: "LLCP.XPT ")
    out = archive.unpack(spark, zips, f"{d}/u", xpt_first=True).collect()
    assert len(out) == 1 and out[0].member == "LLCP.XPT"
    assert read_xport(spark, out[0].path).count() == 5


def test_csv_and_zip_bundle_with_missing_member(spark, sf0001):
    d = tempfile.mkdtemp(prefix="csv-")
    nation = A.table(spark, sf0001, "nation")
    nation.coalesce(1).write.option("header", True).csv(f"{d}/nation")
    csv = list_files(f"{d}/nation", ".csv")[0]
    zips = archive.zip_files(spark, [csv], f"{d}/z", member_name=lambda f: "food.csv")
    rep = ingest(spark, [{"format": "zip_csv", "path": zips[0], "members": ["food.csv", "nutrient.csv"],
                          "prefix": "FDC_"}], f"{d}/store", f"{d}/scratch")
    got = {r.table_name: (r.status, r.n_rows, r.n_cols) for r in rep.collect()}
    assert got == {"FDC_FOOD": ("ok", 25, 3), "FDC_NUTRIENT": ("missing", None, None)}
    inferred = read_csv(spark, csv)
    assert dict(inferred.dtypes)["n_nationkey"] == "int"


def test_replace_sink_list_and_copy(spark, sf0001):
    d = tempfile.mkdtemp(prefix="store-")
    write_replace(A.table(spark, sf0001, "region"), f"{d}/a", "t1")
    write_replace(A.table(spark, sf0001, "nation"), f"{d}/a", "t1", cluster_by=["n_regionkey"])
    assert scan_table(spark, f"{d}/a", "t1").count() == 25
    write_replace(A.table(spark, sf0001, "region"), f"{d}/a", "t2")
    assert [r.table_name for r in list_tables(spark, f"{d}/a").collect()] == ["t1", "t2"]
    names = copy_all(spark, f"{d}/a", f"{d}/b")
    assert {r.table_name: r.n_rows for r in row_counts(spark, f"{d}/b", names).collect()} == {"t1": 25, "t2": 5}


def test_ingest_isolates_failures(spark, sf0001):
    d = tempfile.mkdtemp(prefix="ing-")
    A.table(spark, sf0001, "region").write.option("header", True).csv(f"{d}/region")
    rep = ingest(spark, [{"name": "BAD", "format": "csv", "path": f"{d}/nope.csv"},
                         {"name": "GOOD", "format": "csv", "path": f"{d}/region", "columns": ["r_name", "zz"]}],
                 f"{d}/store", f"{d}/scratch")
    got = {r.table_name: (r.status, r.n_rows, r.n_cols, r.error) for r in rep.collect()}
    assert got["BAD"][0] == "error" and got["BAD"][3] == "PATH_NOT_FOUND"
    assert got["GOOD"] == ("ok", 5, 1, None)


def test_zip_members_and_archives_of_one_name_keep_apart(spark):
    import os
    import zipfile
    d = tempfile.mkdtemp(prefix="zz-")
    for k in "xy":
        os.makedirs(f"{d}/{k}")
        with zipfile.ZipFile(f"{d}/{k}/b.zip", "w") as z:
            z.writestr("a/t.csv", f"v\n{k}1\n")
            z.writestr("b/t.csv", f"v\n{k}2\n")
    out = archive.unpack(spark, [f"{d}/x/b.zip", f"{d}/y/b.zip"], f"{d}/u", members=["t.csv"]).collect()
    assert len({r.path for r in out}) == 4
    got = spark.read.option("header", True).csv([r.path for r in out])
    assert sorted(r.v for r in got.collect()) == ["x1", "x2", "y1", "y2"]


def _xpt(spark, path, rows, ddl, parts=1):
    write_xport(spark.createDataFrame(rows, ddl).repartition(parts), path)
    return list_files(path)


def test_xport_second_member_is_refused(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="xm-")
    one = open(_xpt(spark, f"{d}/a", [(float(i),) for i in range(5)], "K double")[0], "rb").read()
    two = open(_xpt(spark, f"{d}/b", [(float(i),) for i in range(90)], "J double")[0], "rb").read()
    with open(f"{d}/both.xpt", "wb") as f:
        f.write(one + two[240:])
    for per in (3, 1000):
        with pytest.raises(Exception, match="several members"):
            spark.read.format("xport").option("recordsPerPartition", per).load(f"{d}/both.xpt").collect()


def test_xport_folder_has_the_variables_of_all_files(spark):
    import shutil
    d = tempfile.mkdtemp(prefix="xf-")
    shutil.copy(_xpt(spark, f"{d}/a", [(1.0, "p")], "K double, A string")[0], f"{d}/1.xpt")
    shutil.copy(_xpt(spark, f"{d}/b", [(2.0, 5.0)], "K double, B double")[0], f"{d}/2.xpt")
    shutil.rmtree(f"{d}/a")
    shutil.rmtree(f"{d}/b")
    assert sorted(tuple(r) for r in read_xport(spark, f"file://{d}").collect()) == [(1.0, "p", None), (2.0, None, 5.0)]


def test_xport_overwrite_and_append(spark):
    d = tempfile.mkdtemp(prefix="xo-")
    _xpt(spark, f"{d}/t", [(float(i),) for i in range(100)], "K double", 4)
    _xpt(spark, f"{d}/t", [(1.0,), (2.0,), (3.0,)], "K double")
    assert read_xport(spark, f"{d}/t").count() == 3
    spark.createDataFrame([(4.0,)], "K double").write.format("xport").mode("append").save(f"{d}/t")
    assert sorted(r.K for r in read_xport(spark, f"{d}/t").collect()) == [1.0, 2.0, 3.0, 4.0]


def test_unreadable_is_not_missing(spark):
    import pytest
    from cosecha.operators.survey import table_inventory
    d = tempfile.mkdtemp(prefix="inv-")
    with open(f"{d}/bad.parquet", "w") as f:
        f.write("no parquet")
    load = {"bad": lambda: spark.read.parquet(f"{d}/bad.parquet"), "gone": lambda: spark.read.parquet(f"{d}/gone")}
    assert [r.status for r in table_inventory(spark, {"gone": load["gone"]}).collect()] == ["missing"]
    with pytest.raises(Exception):
        table_inventory(spark, load).collect()


def test_every_clustered_column_prunes_row_groups(spark, sf001):
    import pyarrow.parquet as pq
    d = tempfile.mkdtemp(prefix="zc-")
    orders = A.table(spark, sf001, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                    F.concat(F.lit("Clerk#"), F.lpad((F.col("o_custkey") * 7919 % 1000).cast("string"), 9, "0")).alias("clerk"))
    by = ["o_custkey", "o_totalprice", "clerk"]
    write_replace(orders, d, "o", cluster_by=by, partitions=64)
    back = scan_table(spark, d, "o")
    assert back.columns == orders.columns and back.exceptAll(orders).count() == 0 and back.count() == orders.count()
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in list_files(f"{d}/o", ".parquet")
              for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert len(groups) >= 48
    for c in by:
        at = orders.columns.index(c)
        read = []
        for v in [r[c] for r in orders.select(c).orderBy(F.xxhash64(c)).limit(20).collect()]:
            read.append(sum(g.column(at).statistics.min <= v <= g.column(at).statistics.max for g in groups))
        assert sum(read) / len(read) < 0.5 * len(groups), (c, read)


def test_clustering_takes_nulls_dates_and_no_rows(spark):
    d = tempfile.mkdtemp(prefix="zn-")
    df = spark.sql("SELECT id, if(id % 3 = 0, null, concat('é', id)) AS t, date_add(date '2020-01-01', cast(id AS int)) AS day, "
                   "cast(null AS double) AS none FROM range(200)")
    for name, rows in (("all", df), ("empty", df.limit(0))):
        write_replace(rows, d, name, cluster_by=["t", "day", "none"], partitions=4)
        assert scan_table(spark, d, name).exceptAll(rows).count() == 0 and scan_table(spark, d, name).count() == rows.count()


def test_places_on_the_curve_are_compiled_and_count_the_bounds_below(spark):
    """No list is walked row by row; NaN, NULL, ties and one value keep their ranks."""
    import random

    from pyspark.sql import functions as F

    from cosecha.sources import tables as tb
    r = random.Random(2)
    values = [None, float("nan"), 0.0, -0.0, 7.0] + [r.gauss(0, 9) for _ in range(400)]
    df = spark.createDataFrame([(v, i % 5, 1) for i, v in enumerate(values)], "a double, b int, same int").coalesce(1)
    placed = tb.interleave(df, ["a", "b", "same"], "z")
    assert "lambda" not in placed._jdf.queryExecution().executedPlan().toString()
    probes = [i / (1 << tb.BITS) for i in range(1, 1 << tb.BITS)]
    bounds = df.agg(*[F.approx_percentile(F.col(c).cast("double"), probes, 1000) for c in df.columns]).first()
    for *row, got in placed.collect():
        exp = 0
        for i, (v, at) in enumerate(zip(row, bounds)):
            above = lambda b, v=v: b == b and v is not None and (v != v or b < v)
            rank = len({b for b in at if above(b)})
            exp |= sum((rank >> j & 1) << (3 * j + i) for j in range(tb.BITS))
        assert got == exp


def test_a_task_for_every_member(spark):
    import zipfile
    d = tempfile.mkdtemp(prefix="zm-")
    with zipfile.ZipFile(f"{d}/b.zip", "w") as z:
        for i in range(20):
            z.writestr(f"m{i}.csv", f"v\n{i}\n")
    got = archive.unpack(spark, [f"{d}/b.zip"], f"{d}/u")
    assert got.rdd.getNumPartitions() == 20
    rows = got.collect()
    assert sorted(r.member for r in rows) == sorted(f"m{i}.csv" for i in range(20))
    assert {r.v for r in spark.read.option("header", True).csv([r.path for r in rows]).collect()} == {str(i) for i in range(20)}


def test_rows_are_counted_by_the_write(spark, sf0001):
    from pyspark.sql import Observation
    d = tempfile.mkdtemp(prefix="ob-")
    for by in (None, ["n_name"], ["n_name", "n_regionkey"]):
        rows = Observation()
        write_replace(A.table(spark, sf0001, "nation"), d, "n", cluster_by=by, observed=rows)
        assert rows.get["n"] == 25


def _members(path, *files):
    """One transport file of the members of several."""
    data = open(files[0], "rb").read()
    for f in files[1:]:
        data += open(f, "rb").read()[240:]
    with open(path, "wb") as out:
        out.write(data)


def test_xport_members_are_indexed_and_read_by_name(spark):
    d = tempfile.mkdtemp(prefix="xn-")
    one = spark.range(500).selectExpr("cast(id AS double) AS K", "concat('r', id) AS T").coalesce(1)
    two = spark.range(70).selectExpr("cast(id * 2 AS double) AS J").coalesce(1)
    write_xport(one, f"{d}/a", member="DEMO")
    write_xport(two, f"{d}/b", member="LAB")
    a, b = list_files(f"{d}/a")[0], list_files(f"{d}/b")[0]
    _members(f"{d}/both.xpt", a, b)
    _members(f"{d}/three.xpt", b, a, b)
    from cosecha.sources.xport import member_index
    for size in (160, 4096, 1 << 20):  # headers found whatever range they begin in
        found = sorted((r.file.rsplit("/", 1)[-1], r.member, r.n_records) for r in
                       member_index(spark, f"{d}/*.xpt", scan_bytes=size).collect())
        assert found == [("both.xpt", "DEMO", 500), ("both.xpt", "LAB", 70), ("three.xpt", "DEMO", 500),
                         ("three.xpt", "LAB", 70), ("three.xpt", "LAB", 70)]
    demo = read_xport(spark, f"{d}/*.xpt", member="demo", recordsPerPartition=64)
    assert sorted(tuple(r) for r in demo.collect()) == sorted(tuple(r) for r in one.union(one).collect())
    assert sorted(r.J for r in read_xport(spark, f"{d}/three.xpt", member="LAB").collect()) == sorted([2.0 * i for i in range(70)] * 2)
    import pytest
    with pytest.raises(FileNotFoundError):
        read_xport(spark, f"{d}/both.xpt", member="NONE")


def test_xport_filters_decode_fewer_cells(spark, monkeypatch):
    import pytest

    from cosecha.sources import xport as X
    d = tempfile.mkdtemp(prefix="xp-")
    df = spark.range(1000).selectExpr("cast(id AS double) AS K", "if(id % 7 = 0, null, cast(id % 10 AS double)) AS V",
                                      "concat('n', id % 3) AS T", "cast(id * 3 AS double) AS W").coalesce(1)
    write_xport(df, d)
    cases = {"V = 3": [("V", "=", 3)], "V IN (1, 2)": [("v", "in", [1, 2, None])], "V IS NULL": [("V", "is null")],
             "V > 7.5 AND T = 'n1'": [("V", ">", 7.5), ("T", "=", "n1")], "K >= 990 AND V IS NOT NULL": [("K", ">=", 990),
             ("V", "is not null")], "T IN ('n0', 'zz') AND K <= 20": [("T", "in", ["n0", "zz"]), ("K", "<=", 20)], "V = 99": [("V", "=", 99)]}
    for cond, filters in cases.items():
        got = read_xport(spark, d, filters=filters)
        assert sorted(map(str, got.collect())) == sorted(map(str, df.where(cond).collect())), cond
    # a filter on a variable that isn't read
    assert read_xport(spark, d, columns=["W"], filters=[("T", "=", "n2")]).count() == df.where("T = 'n2'").count()
    assert read_xport(spark, d, filters=[("GONE", "=", "x")]).count() == 0  # in no file
    assert read_xport(spark, d, filters=[("GONE", "is null")]).count() == 1000
    cells = []
    decode = X.ibm_to_double
    monkeypatch.setattr(X, "ibm_to_double", lambda raw: cells.append(len(raw)) or decode(raw))
    import json
    reader = X.XportReader({"path": d, "filters": json.dumps([("V", "=", 3.0), ("T", "in", ["n0", "n1"])])}, df.schema)
    rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert rows == df.where("V = 3 AND T IN ('n0', 'n1')").count() and cells == [1000, rows, rows]
    with pytest.raises(ValueError):
        read_xport(spark, d, filters=[("V", "like", "x")])
