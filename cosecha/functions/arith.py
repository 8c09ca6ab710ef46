"""Null-aware arithmetic.

ANSI mode stays on; division that may hit zero goes through ``try_divide``,
which yields NULL where pandas would give inf/NaN (documented deviation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cosecha._util import col


def fill(c, value) -> Column:
    """``fillna(value)``: NULL -> constant."""
    return F.coalesce(col(c), F.lit(value))


def fill0(c) -> Column:
    return fill(c, 0)


def null_if(c, value) -> Column:
    """``replace(value, nan)``: the given value -> NULL."""
    return F.nullif(col(c), F.lit(value))


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(col(num), col(den))


def round_half_even(c, digits: int = 2) -> Column:
    """``Series.round(digits)`` (banker's rounding)."""
    return F.bround(col(c), digits)
