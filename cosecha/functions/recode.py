"""Dictionary recoding.

``Series.map(d)`` sends values absent from ``d`` to NULL; ``Series.replace(d)``
keeps them. Both become one ``CASE`` over the (small, literal) dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cosecha._util import col


def _case(c: Column, mapping: dict, default: Column | None) -> Column:
    out = None
    for k, v in mapping.items():
        cond = c.isNull() if k is None else (c == F.lit(k))
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    if out is None:
        return default if default is not None else F.lit(None)
    return out.otherwise(default) if default is not None else out


def recode_map(c, mapping: dict) -> Column:
    """``map``: unmapped -> NULL."""
    return _case(col(c), mapping, None)


def recode_replace(c, mapping: dict) -> Column:
    """``replace``: unmapped -> unchanged (types of keys and values must agree)."""
    cc = col(c)
    return _case(cc, mapping, cc)


def replace_values(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    return df.withColumn(column, recode_replace(column, mapping))
