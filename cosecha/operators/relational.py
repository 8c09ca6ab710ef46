"""Projections, filters, joins, ordering and unions (F1-F7, F11-F13, J1-J2,
O1-O5).

All of these are thin compositions of DataFrame calls; they exist so that the
flows read like the analyses they reproduce, and so the pandas semantics that
differ from SQL (null keys, case-insensitive substring, by-name unions with
mixed key types) are handled once."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cosecha._util import resolve_existing


def _case_sensitive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def select_cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F1 ``df[[...]]``."""
    return df.select(*columns)


def select_existing(df: DataFrame, wanted: Sequence[str], case_sensitive: bool | None = None) -> DataFrame:
    """keep the listed columns that exist, in list order. Matching follows the
    session's ``spark.sql.caseSensitive`` unless given."""
    cs = _case_sensitive(df) if case_sensitive is None else case_sensitive
    return df.select(*resolve_existing(df.columns, wanted, cs))


def has_columns(df: DataFrame, *names: str) -> bool:
    """F8 column-exists guard, decided when the plan is built."""
    return len(resolve_existing(df.columns, names, _case_sensitive(df))) == len(names)


def column_or_null(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """F8: the column if present, else a typed NULL."""
    found = resolve_existing(df.columns, [name], _case_sensitive(df))
    return F.col(found[0]) if found else F.lit(None).cast(dtype)


def filter_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """F3 ``isin``."""
    return df.where(F.col(column).isin(list(values)))


def filter_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F4 ``dropna(subset=...)`` / conjunctive ``IS NOT NULL``."""
    return df.dropna(how="any", subset=list(columns))


def filter_where(df: DataFrame, *conditions: Column) -> DataFrame:
    """F5 conjunction of predicates (NULL counts as false, as in pandas masks)."""
    return df.where(reduce(lambda a, b: a & b, conditions))


def filter_contains(df: DataFrame, column: str, pattern: str, case: bool = False,
                    regex: bool = False) -> DataFrame:
    """F6 ``str.contains(pattern, case=...)``."""
    c = F.col(column)
    if regex:
        return df.where(c.rlike(pattern if case else "(?i)" + pattern))
    if case:
        return df.where(c.contains(pattern))
    return df.where(F.lower(c).contains(pattern.lower()))


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """F11 tag column."""
    return df.withColumn(name, F.lit(value))


def with_flag(df: DataFrame, name: str, *conditions: Column) -> DataFrame:
    """F12 boolean flag = AND of predicates; NULL comparisons give false."""
    cond = reduce(lambda a, b: a & b, conditions)
    return df.withColumn(name, F.coalesce(cond, F.lit(False)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """F13 ``unique()`` (NULL kept once, as pandas does)."""
    return df.select(column).distinct()


def join_inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J1; the planner picks broadcast (by measured size) or sort-merge."""
    return left.join(right, on=on, how="inner")


def join_left(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J2; duplicate right keys multiply rows, as ``merge`` does."""
    return left.join(right, on=on, how="left")


def order_desc(df: DataFrame, measure: str, *tie_break: str) -> DataFrame:
    """O1 sort by a measure, descending, with a unique tie-break."""
    return df.orderBy(F.col(measure).desc(), *[F.col(c).asc() for c in tie_break])


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """O2 ``head(k)`` after a sort: TakeOrderedAndProject, no global sort."""
    return df.orderBy(*order).limit(k)


def union_by_name(frames: Sequence[DataFrame], as_string: Sequence[str] = ()) -> DataFrame:
    """O5 ``concat(ignore_index=True)``: union all by name, missing columns NULL.
    Columns in ``as_string`` are cast to string first so that keys of
    different types (int vs string codes) can be stacked."""
    fixed = []
    for f in frames:
        for c in as_string:
            if c in f.columns:
                f = f.withColumn(c, F.col(c).cast("string"))
        fixed.append(f)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fixed)
