"""Table scans, the replace sink and whole-store operations.

A *store* is either a folder of Parquet tables (one sub-folder per table,
any Hadoop-compatible file system) or a catalog database."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cosecha.session import materialize


def scan_table(spark: SparkSession, store: str, name: str, fmt: str = "parquet") -> DataFrame:
    """S5 ``SELECT * FROM t``: lazy scan; projections and filters applied later
    are pushed into the Parquet reader by Catalyst."""
    if _is_path(store):
        return spark.read.format(fmt).load(f"{store.rstrip('/')}/{name}")
    return spark.table(f"{store}.{name}")


def scan_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """S6 a SQL text over DataFrames bound to ``{name}`` placeholders (no
    global temp views; Catalyst sees one plan)."""
    return spark.sql(sql, **tables)


#: sampled bounds of a column that several columns are clustered by: ranks 0 to 2^BITS - 1
BITS = 6


def _order_keys(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """A number per column that never falls when the column's value grows: the value
    itself, or the six bytes of a text behind what all its texts begin with."""
    texts = [c for c in columns if df.schema[c].dataType.typeName() == "string"]
    ends = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(texts) for n, f in (("a", F.min), ("z", F.max))]) \
        .first() if texts else None
    keys = []
    for c in columns:
        kind = df.schema[c].dataType.typeName()
        if c in texts:
            a, z = (((ends[f"{n}_{texts.index(c)}"]) or "").encode() for n in "az")
            same = next((i for i, (x, y) in enumerate(zip(a, z)) if x != y), min(len(a), len(z)))
            rest = F.hex(F.substring(F.encode(F.col(c), "UTF-8"), same + 1, 6))
            keys.append(F.conv(F.rpad(rest, 12, "0"), 16, 10).cast("double"))
        elif kind in ("date", "timestamp"):
            keys.append(F.unix_timestamp(F.col(c).cast("timestamp")).cast("double"))
        else:
            keys.append(F.col(c).cast("double"))
    return keys


def interleave(df: DataFrame, columns: Sequence[str], out: str, bits: int = BITS) -> DataFrame:
    """``df`` with ``out``, the place of a row on a space-filling curve over several
    columns: each column's rank among its quantile bounds, the bits of the ranks taken in
    turns. Rows near in any column are near on the curve, so files cut along it have narrow
    ranges of every column. NULL ranks lowest. Two aggregates over ``df``.

    A rank is found by a binary search, a projection for every step: plain comparisons
    that Spark compiles (a function over the list of bounds would be run value by value)."""
    keys = _order_keys(df, columns)
    probes = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*[F.approx_percentile(k, probes, 1000).alias(f"b{i}") for i, k in enumerate(keys)]).first()
    # nothing lies above NaN
    at = [F.lit(sorted({b for b in bounds[f"b{i}"] or [] if b == b}) or [float("inf")]) for i in range(len(keys))]
    key, rank = ([f"{out}_{n}{i}" for i in range(len(keys))] for n in ("key", "rank"))
    placed = df.withColumns({**dict(zip(key, keys)), **{r: F.lit(0) for r in rank}})
    for j in reversed(range(bits)):  # so many of the bounds lie below the key, or more
        more = [F.get(a, F.col(r) + F.lit((1 << j) - 1)) < F.col(k) for a, r, k in zip(at, rank, key)]
        placed = placed.withColumns({r: F.when(m, F.col(r) + F.lit(1 << j)).otherwise(F.col(r))
                                     for r, m in zip(rank, more)})
    z = F.lit(0)
    for i, r in enumerate(rank):
        for j in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(r), j).bitwiseAND(F.lit(1)), j * len(keys) + i))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], z.alias(out))


def write_replace(df: DataFrame, store: str, name: str, fmt: str = "parquet",
                  cluster_by: Sequence[str] | None = None, partitions: int | None = None,
                  options: Mapping[str, str] | None = None, observed: Observation | None = None) -> str:
    """S7 ``to_sql(if_exists='replace')``: overwrite the whole table.

    ``cluster_by`` range-partitions and sorts before writing so Parquet row-group
    min/max statistics serve later filters (the Spark counterpart of the secondary
    indexes the source pipeline builds): by one column itself, by several along a
    space-filling curve over all of them (``interleave``), so that each prunes.
    ``observed`` gets ``n``, the rows written, counted by the write itself in its
    last stage (a repeated task is counted once)."""
    order = list(cluster_by or [])
    if len(order) > 1:
        df = materialize(df, "to-cluster")  # scanned for bounds, then written
        columns, df = df.columns, interleave(df, order, "__z")
        order = ["__z", *order]
    if order:
        # without a count the adaptive planner sizes the files by bytes
        df = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
        df = df.sortWithinPartitions(*order)
        df = df.select(*columns) if order[0] == "__z" else df
    elif partitions:
        df = df.repartition(partitions)
    if observed is not None:
        df = df.observe(observed, F.count(F.lit(1)).alias("n"))
    w = df.write.mode("overwrite").format(fmt).options(**(options or {}))
    if _is_path(store):
        target = f"{store.rstrip('/')}/{name}"
        w.save(target)
        return target
    w.saveAsTable(f"{store}.{name}")
    return f"{store}.{name}"


def list_tables(spark: SparkSession, store: str) -> DataFrame:
    """S8 names of the tables in a store, as a DataFrame (``table_name``).

    For a folder store this is a metadata listing through the Hadoop file
    system API on the driver (names only, never data)."""
    if _is_path(store):
        names = _list_dirs(spark, store)
    else:
        names = [t.name for t in spark.catalog.listTables(store) if not t.isTemporary]
    return spark.createDataFrame([(n,) for n in sorted(names)], "table_name string")


def copy_all(spark: SparkSession, source: str, target: str, fmt: str = "parquet",
             options: Mapping[str, str] | None = None, source_fmt: str = "parquet") -> list[str]:
    """S9 copy every table of ``source`` to ``target`` with replace semantics.
    ``fmt``/``options`` select the target writer (``parquet``, ``jdbc`` with
    the caller's url/user/password options, ...; the table is always named as
    in ``source``). Each copy is one distributed read-write job, several run at
    a time; nothing passes through the driver."""
    names = [r.table_name for r in list_tables(spark, source).collect()]

    def copy(n: str) -> None:
        df = scan_table(spark, source, n, source_fmt)
        if fmt == "jdbc":
            df.write.mode("overwrite").format("jdbc").options(**{**(options or {}), "dbtable": n}).save()
        else:
            write_replace(df, target, n, fmt=fmt, options=options)

    concurrently(copy, names)
    return names


def concurrently(job, items: Sequence) -> list:
    """Run independent Spark jobs side by side; results in order, the first
    failure is raised."""
    from concurrent.futures import ThreadPoolExecutor
    if not items:
        return []
    with ThreadPoolExecutor(min(4, len(items))) as pool:
        return list(pool.map(job, items))


def row_counts(spark: SparkSession, store: str, names: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """(table_name, n_rows) for the given tables, as one lazy union."""
    parts = [scan_table(spark, store, n, fmt).agg(F.lit(n).alias("table_name"),
                                                  F.count(F.lit(1)).alias("n_rows")) for n in names]
    if not parts:
        return spark.createDataFrame([], "table_name string, n_rows long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _is_path(store: str) -> bool:
    return "/" in store or ":" in store


def _list_dirs(spark: SparkSession, store: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(store)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")):
            out.append(name)
    return out
