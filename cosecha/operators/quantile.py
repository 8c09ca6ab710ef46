"""Exact quantiles and quantile bins (A13, A14, E15), distributed.

``pandas.qcut`` / ``np.percentile`` use linear interpolation between order
statistics: for ``n`` values and fraction ``p``, ``h = (n-1)p`` and the result
is ``x[floor h] + (x[ceil h] - x[floor h]) * (h - floor h)``.

Spark's exact ``percentile`` keeps every distinct value of a group in one
task's hash map, and a global window sorts everything in one task. Neither
survives a 100 TB column, so the order statistics are selected by histograms:

1. one aggregate counts the values of each group in cells that are known
   before any value is seen: sign, power of two and an even part of it. With the
   count, the least and greatest value of a cell are kept;
2. running counts over a group's cells (a bounded number, whatever the data)
   tell the cell in which a wanted rank lies, and how many values are below it;
3. the values in those cells alone are counted again, in even parts of the cell
   between its least and greatest value (or value by value, if the cell holds no
   more than a histogram has parts), until a cell holds one value.

A cell shrinks by the number of its parts each time, so few rounds do: two for
up to some 10^8 rows a group, and at most five for any doubles. Every round is
a scan with map-side combine; only the wanted cells are written, a few rows a
group. No task holds more than the cells of a group.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cosecha.session import materialize

#: parts of a cell in the rounds after the first, and parts of a power of two in the first
DEFAULT_BUCKETS = 1 << 16
FIRST_PARTS = 1024


def linspace_fractions(q: int) -> list[float]:
    """The fractions ``pandas.qcut(x, q)`` ends up using, bit for bit: the
    ``numpy.linspace`` points, passed to ``np.percentile`` as percentages and
    divided by 100 again (2/3 becomes 0.6666666666666665). With exactly these
    doubles the edges, and so the bins of tied data, equal pandas'."""
    return [float(x) for x in (np.linspace(0, 1, q + 1) * 100) / 100]


def _first_cell(v: Column, parts: int) -> Column:
    """Number of the cell of ``v``: never falls when ``v`` grows."""
    size = F.abs(v)
    power = F.floor(F.log2(size))
    part = F.least(F.greatest(F.floor((size / F.pow(F.lit(2.0), power) - 1) * parts), F.lit(0)), F.lit(parts - 1))
    cell = F.when(size == float("inf"), F.lit(4096).cast("bigint") * parts).otherwise((power + 1100) * parts + part)
    return F.when(size == 0, F.lit(0).cast("bigint")).when(v < 0, -cell).otherwise(cell)


def _wanted_ranks(n: Column, fr: Sequence[float]) -> Column:
    """The order statistics (0-based ranks) the interpolation needs."""
    return F.array_distinct(F.concat(*[F.array(F.floor((n - 1) * F.lit(p)), F.ceil((n - 1) * F.lit(p)))
                                       for p in fr]))


def _interpolate(vals: DataFrame, by: list, fr: Sequence[float], out: str) -> DataFrame:
    """``_m`` (rank -> value) and ``_n`` -> the quantiles, interpolated the
    way numpy's ``linear`` method does (``lo + diff*t`` below t = 0.5,
    ``hi - diff*(1-t)`` from there), so bins agree with ``pandas.qcut``."""
    qs = []
    for p in fr:
        h = (F.col("_n") - 1) * F.lit(p)
        t = h - F.floor(h)
        lo = F.try_element_at("_m", F.floor(h))
        hi = F.try_element_at("_m", F.ceil(h))
        diff = hi - lo
        qs.append(F.when(t >= F.lit(0.5), hi - diff * (F.lit(1.0) - t)).otherwise(lo + diff * t))
    return vals.select(*by, F.col("_n").alias("n"), F.array(*qs).alias(out))


def _cells(counted: DataFrame, keys: list, at: Column) -> DataFrame:
    """Of the counted cells of each of ``keys`` those that hold a wanted rank:
    ``_at`` values are below the cell, ``_rb`` are the ranks in it."""
    upto = Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("_at", at + F.sum("_c").over(upto) - F.col("_c"))
    return placed.withColumn("_rb", F.filter("_r", lambda r: (r >= F.col("_at")) & (r < F.col("_at") + F.col("_c")))) \
        .where(F.size("_rb") > 0)


def _narrow(base: DataFrame, cells: DataFrame, by: list, buckets: int) -> DataFrame:
    """The wanted cells inside ``cells``, from the values that lie there."""
    cell = F.struct("_mn", "_mx", "_at", "_c", "_n", "_rb")
    if by:
        rows = base.join(cells.groupBy(*by).agg(F.collect_list(cell).alias("_w")), by)
    else:
        rows = base.withColumn("_w", cells.agg(F.collect_list(cell)).scalar())
    v = F.col("_v")
    rows = rows.select(*by, "_v", F.explode(F.filter("_w", lambda w: (v >= w["_mn"]) & (v <= w["_mx"]))).alias("_w"))
    part = F.floor((v - F.col("_w._mn")) / (F.col("_w._mx") - F.col("_w._mn")) * buckets).cast("double")
    key = F.when(F.col("_w._c") <= buckets, v).otherwise(part)
    counted = rows.groupBy(*by, F.col("_w._mn").alias("_cell"), key.alias("_k")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"),
        F.first("_w._at").alias("_below"), F.first("_w._n").alias("_n"), F.first("_w._rb").alias("_r"))
    return _cells(counted, [*by, "_cell"], F.col("_below")).select(*by, "_mn", "_mx", "_at", "_c", "_n", "_rb")


def exact_quantiles(df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = (),
                    out: str = "quantiles", buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """One row per group (one row in total without ``by``): ``by`` columns,
    ``n`` (non-null values) and ``out`` = array of quantiles in ``fractions``
    order. NULL values and NULL group keys are ignored (pandas). One way for
    groups of every size: no task holds more than the cells of a group."""
    by = list(by)
    fr = [float(p) for p in fractions]
    v = F.col(value).cast("double")
    base = df.select(*[F.col(c) for c in by], v.alias("_v"))
    base = base.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    for c in by:
        base = base.where(F.col(c).isNotNull())

    counted = base.groupBy(*by, _first_cell(F.col("_v"), min(FIRST_PARTS, buckets)).alias("_k")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    counted = counted.withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    counted = counted.withColumn("_r", _wanted_ranks(F.col("_n"), fr))
    cells = _cells(counted, by, F.lit(0).cast("bigint")).select(*by, "_mn", "_mx", "_at", "_c", "_n", "_rb")
    found, cells = [], materialize(cells, "quantile-cells")
    wide = F.col("_mn") < F.col("_mx")
    while True:
        found.append(cells.where(~wide))
        if cells.where(wide & (F.col("_c") > buckets)).isEmpty():
            break  # one more round, value by value, leaves single values
        cells = materialize(_narrow(base, cells.where(wide), by, buckets), "quantile-cells")
    found.append(_narrow(base, cells.where(wide), by, buckets))
    hits = reduce(DataFrame.unionByName, found).select(*by, F.explode("_rb").alias("_rank"), F.col("_mn").alias("_v"), "_n")
    values = hits.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_m"),
                                   F.max("_n").alias("_n"))
    return _interpolate(values if by else values.where(F.col("_n").isNotNull()), by, fr, out)


def quantile_edges(df: DataFrame, value: str, q: int, by: Sequence[str] = (),
                   out: str = "edges", **kw) -> DataFrame:
    """A13 ``qcut(..., retbins=True, duplicates='drop')`` edges: the linspace
    quantiles with exact duplicates dropped (ascending)."""
    e = exact_quantiles(df, value, linspace_fractions(q), by, out="_q", **kw)
    return e.select(*by, "n", F.array_distinct("_q").alias(out))


def bin_of(v: Column, edges: Column) -> Column:
    """Right-closed bin number (1-based) with the lowest edge included; NULL
    for NULL/NaN values, values outside the edges, or fewer than two edges."""
    interior = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    return (F.when(v.isNull() | F.isnan(v) | (F.size(edges) < 2), F.lit(None))
             .when((v < F.element_at(edges, 1)) | (v > F.element_at(edges, -1)), F.lit(None))
             .otherwise(F.size(F.filter(interior, lambda e: e < v)) + 1))


def label_of(bin_no: Column, n_bins: Column, labels: Sequence[str] | None, prefix: str = "Q") -> Column:
    """Fixed labels when exactly that many bins survive, else ``Q1..Qk``
    (``qcut`` would raise on the mismatch and lose the whole table)."""
    generated = F.concat(F.lit(prefix), bin_no.cast("string"))
    if not labels:
        return F.when(bin_no.isNotNull(), generated)
    fixed = F.element_at(F.array(*[F.lit(x) for x in labels]), bin_no)
    return (F.when(bin_no.isNull(), F.lit(None))
             .when(n_bins == F.lit(len(labels)), fixed)
             .otherwise(generated))


def qcut_edges(df: DataFrame, value: str, q: int, by: Sequence[str] = (), **kw) -> DataFrame:
    """The (small, materialised) edges table shared by ``qcut`` and
    ``bin_labels``: ``by`` columns + ``_e``."""
    return materialize(quantile_edges(df, value, q, by, out="_e", **kw).select(*by, "_e"))


def qcut(df: DataFrame, value: str, q: int, labels: Sequence[str] | None = None,
         out: str = "bin", bin_col: str | None = None, by: Sequence[str] = (),
         edges: DataFrame | None = None, **kw) -> DataFrame:
    """A14 ``pd.qcut(x, q, labels, duplicates='drop')`` over the whole column
    (or per group with ``by``). Adds the label column ``out`` and, when
    ``bin_col`` is given, the 1-based bin number used for ordering.

    The edges are attached as a scalar subquery (one row) or, per group, by
    an equi-join on the group key (one row per group)."""
    edges = edges if edges is not None else qcut_edges(df, value, q, by, **kw)
    if by:
        with_e = df.join(edges, list(by), "left")
    else:
        with_e = df.withColumn("_e", edges.select("_e").scalar())
    b = bin_of(F.col(value).cast("double"), F.col("_e"))
    res = with_e.withColumn("_bin", b).withColumn(
        out, label_of(F.col("_bin"), F.size("_e") - 1, labels))
    if bin_col:
        res = res.withColumnRenamed("_bin", bin_col)
    else:
        res = res.drop("_bin")
    return res.drop("_e")


def bin_labels(df: DataFrame, value: str, q: int, labels: Sequence[str] | None = None,
               label_col: str = "bin", bin_col: str = "bin_no", by: Sequence[str] = (),
               edges: DataFrame | None = None, **kw) -> DataFrame:
    """Every surviving bin of ``qcut`` (one row per bin, empty bins included),
    for left-joining grouped results so empty categories still show (pandas
    categorical groupby)."""
    edges = edges if edges is not None else qcut_edges(df, value, q, by, **kw)
    nb = F.size("_e") - 1
    rows = edges.where(nb >= 1).select(*by, nb.alias("_nb"),
                                       F.explode(F.sequence(F.lit(1), nb)).alias(bin_col))
    return rows.select(*by, bin_col, label_of(F.col(bin_col), F.col("_nb"), labels).alias(label_col))
