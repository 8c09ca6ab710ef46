"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def resolve_existing(df_columns, wanted, case_sensitive: bool = False):
    """Names from ``wanted`` that exist in ``df_columns``, in ``wanted`` order,
    spelled as in the DataFrame."""
    if case_sensitive:
        have = set(df_columns)
        return [c for c in wanted if c in have]
    have = {c.lower(): c for c in df_columns}
    return [have[c.lower()] for c in wanted if c.lower() in have]
