"""Grouped aggregates, first-non-null and the long-to-wide pivot (A1-A3,
A5-A8).

Everything here is ``groupBy().agg()`` (two of them for first values by a composite
order), so Spark runs a partial (map-side) aggregate before the shuffle: a key that
holds a third of all rows still sends only one partial row per map task."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cosecha._util import col
from cosecha.session import materialize


def order_key(order: Sequence) -> Column:
    cols = [col(c) for c in order]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def first_non_null(value, order: Sequence) -> Column:
    """A2 pandas ``first``: the value of the first row (by an explicit unique
    order) among rows where the value is not NULL."""
    v = col(value)
    return F.min_by(v, F.when(v.isNotNull(), order_key(order)))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas ``groupby`` drops NULL keys (SQL GROUP BY keeps them)."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


_STATS = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,      # sample std, NULL for n = 1 (pandas)
    "count": F.count,          # non-null count
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),   # pandas: sum of all-null = 0
    "median": F.median,
}


def group_stats(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple],
                firsts: Mapping[str, str] | None = None, order: Sequence | None = None,
                dropna: bool = True) -> DataFrame:
    """A1 + A2: ``groupby(keys).agg({col: [stats]}, other: 'first')``.

    ``measures`` maps output name -> (stat, input column); ``firsts`` maps output
    name -> input column, taken by ``first_non_null`` under ``order``.

    A composite order would make ``min_by`` keep a struct and Spark sort all rows by
    the keys. So the aggregate finds the least first order column only (hash based);
    the rows that have it, few a group, then decide by the whole order."""
    if dropna:
        df = drop_null_keys(df, keys)
    aggs = [_STATS[stat](F.col(c)).alias(name) for name, (stat, c) in measures.items()]
    firsts = dict(firsts or {})
    if firsts and keys and len(order) > 1:
        return _stats_then_firsts(df, keys, aggs, list(measures), firsts, order)
    for name, c in firsts.items():
        aggs.append(first_non_null(c, order).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def _stats_then_firsts(df: DataFrame, keys: Sequence[str], aggs: list, measured: list,
                       firsts: Mapping[str, str], order: Sequence) -> DataFrame:
    """``group_stats`` by two scans. Inside a composite order NULL comes before any value."""
    lead = col(order[0])
    least = []
    for i, c in enumerate(firsts.values()):
        there = F.col(c).isNotNull()
        least += [F.min(F.when(there, lead)).alias(f"_lead{i}"),
                  F.coalesce(F.bool_or(there & lead.isNull()), F.lit(False)).alias(f"_null{i}")]
    stats = materialize(df.groupBy(*keys).agg(*aggs, *least), "group-stats")

    # no group's first row lies behind the last of the leads: spares most rows the join
    ends = [F.max(f"_lead{i}") for i in range(len(firsts))]
    last = stats.agg((F.greatest(*ends) if len(ends) > 1 else ends[0]).alias("z")).scalar()
    wanted = stats.select(*[F.col(k).alias(f"_key{j}") for j, k in enumerate(keys)],
                          *[f"_{n}{i}" for i in range(len(firsts)) for n in ("lead", "null")])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key{j}")) for j, k in enumerate(keys)])
    is_first = reduce(or_, [F.when(F.col(f"_null{i}"), lead.isNull()).otherwise(lead == F.col(f"_lead{i}"))
                            for i in range(len(firsts))])
    rows = df.where((lead <= last) | lead.isNull()).join(wanted, same & is_first)
    found = rows.groupBy(*[f"_key{j}" for j in range(len(keys))]).agg(
        *[first_non_null(c, order).alias(f"_first{i}") for i, c in enumerate(firsts.values())])
    return (stats.join(found.withColumnsRenamed({f"_key{j}": f"_of{j}" for j in range(len(keys))}),
                       reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of{j}")) for j, k in enumerate(keys)]), "left")
            .select(*keys, *measured, *[F.col(f"_first{i}").alias(name) for i, name in enumerate(firsts)]))


def pivot_first(df: DataFrame, index: str, columns: str, values: str,
                pivot_values: Sequence, names: Mapping | None = None,
                order: Sequence | None = None) -> DataFrame:
    """A3 ``pivot_table(index, columns, values, aggfunc='first')``.

    NULL cells are dropped before pivoting (an index whose cells are all NULL
    disappears, as in pandas); one output column per listed value, in list
    order, NULL-filled when a value never occurs.

    One grouped aggregate with a conditional ``min_by`` per listed value, so
    the plan has a single exchange and partial (map-side) aggregation: at most
    one row per index value and map task crosses the network (Spark's own
    two-phase pivot would shuffle twice). "First" is the smallest ``order``
    key; with one order column the aggregate is hash based, with a composite
    key ``min_by`` keeps a struct and Spark runs the same single-exchange plan
    as a sort-based aggregate (a level-by-level hash reduction would instead
    shuffle every input row, since its first grouping key is near-unique)."""
    names = names or {}
    order = list(order or [values])
    key = order_key(order)
    src = df.where(F.col(values).isNotNull() & F.col(columns).isin(list(pivot_values)))
    aggs = []
    for v in pivot_values:
        hit = F.col(columns) == F.lit(v)
        aggs.append(F.min_by(F.when(hit, F.col(values)), F.when(hit, key))
                    .alias(str(names.get(v, f"nutrient_{v}"))))
    return src.groupBy(index).agg(*aggs)


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """A8 ``value_counts()``: non-null values with their counts (order it with
    ``top_k``/``orderBy`` at the output)."""
    return (df.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias(name)))


def share_case(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """A6 ``AVG(CASE WHEN cond THEN 1 ELSE 0 END)``: NULL counts as 0."""
    return df.agg(F.avg(F.when(condition, F.lit(1)).otherwise(F.lit(0))).alias(name))
