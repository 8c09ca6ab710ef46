"""Survey tables: prevalence by group, summaries, completeness and table
inventories (A4, A5, A9, A16, A23, F14).

Each is a single grouped or global aggregate; per-group percentages are
column arithmetic on the aggregate output."""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha.operators.aggregate import drop_null_keys


def prevalence(df: DataFrame, group: str, flag: str, total: str = "total",
               positives: str = "con_diabetes", pct: str = "prevalencia_pct",
               group_as: str | None = None) -> DataFrame:
    """A4 ``groupby(group)[flag].agg(count, sum, sum/count*100 or 0)``.

    NULL group keys are dropped; ``total`` counts non-null flags; the sum of an
    all-NULL group is 0; the percentage is 0 when no flag is non-null."""
    f = F.col(flag)
    out = (drop_null_keys(df, [group]).groupBy(group)
           .agg(F.count(f).alias(total), F.coalesce(F.sum(f), F.lit(0)).cast("long").alias(positives)))
    out = out.withColumn(pct, F.when(F.col(total) > 0, F.col(positives) / F.col(total) * F.lit(100))
                         .otherwise(F.lit(0.0)))
    if group_as and group_as != group:
        out = out.withColumnRenamed(group, group_as)
    return out


def conditional_counts(df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column],
                       sums: Mapping[str, str] | None = None, n_name: str | None = None,
                       n_of: str | None = None) -> DataFrame:
    """A5 per-group ``(x == 0).sum()``-style counts, with optional non-null
    count and sums, in one aggregate."""
    aggs = []
    if n_name:
        aggs.append(F.count(F.col(n_of)).alias(n_name))
    for name, c in (sums or {}).items():
        aggs.append(F.coalesce(F.sum(F.col(c)), F.lit(0)).cast("long").alias(name))
    for name, cond in counts.items():
        aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(name))
    return drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def dataset_summary(df: DataFrame, name: str, flag: Column | None, measures: Mapping[str, Column | None],
                    dataset: str = "dataset", n_name: str = "n_participantes",
                    pct: str = "prevalencia_diabetes_pct") -> DataFrame:
    """A9 one-row summary: row count, flag rate over non-null flags, means.
    Absent inputs (F8 guards) become typed NULLs."""
    aggs = [F.lit(name).alias(dataset), F.count(F.lit(1)).alias(n_name)]
    if flag is None:
        aggs.append(F.lit(None).cast("double").alias(pct))
    else:
        aggs.append(F.try_divide(F.sum(flag), F.count(flag)) * F.lit(100))
        aggs[-1] = aggs[-1].cast("double").alias(pct)
    for out, c in measures.items():
        aggs.append((F.avg(c) if c is not None else F.lit(None).cast("double")).alias(out))
    return df.agg(*aggs)


def completeness(df: DataFrame, columns: Sequence[str], name: str = "variable",
                 value: str = "completitud_pct") -> DataFrame:
    """A16 non-null percentage of each listed column that exists, long form.

    One pass computes every ``count(c)`` next to ``count(*)``; ``stack`` turns
    the single row into one row per column."""
    present = [c for c in columns if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(present)]
    wide = df.agg(*aggs)
    if not present:
        return wide.select(F.lit(None).cast("string").alias(name),
                           F.lit(None).cast("double").alias(value)).where(F.lit(False))
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(present))
    return (wide.selectExpr("_rows", f"stack({len(present)}, {pairs}) AS ({name}, _nn)")
                .select(name, (F.try_divide(F.col("_nn"), F.col("_rows")) * F.lit(100)).alias(value)))


def table_inventory(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]],
                    name: str = "table_name", status: str = "status", rows: str = "n_rows") -> DataFrame:
    """A23 row count of each listed table; tables that cannot be resolved are
    reported with status ``missing`` (and NULL rows) instead of failing.

    Resolution happens at plan time on the driver (metadata only); the counts
    are one lazy union of global aggregates."""
    parts = []
    missing = []
    for t, load in tables.items():
        try:
            df = load()
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise  # unreadable is not missing
            missing.append(t)
            continue
        parts.append(df.agg(F.lit(t).alias(name), F.lit("ok").alias(status), F.count(F.lit(1)).alias(rows)))
    schema = f"{name} string, {status} string, {rows} long"
    if missing:
        parts.append(spark.createDataFrame([(t, "missing", None) for t in missing], schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
