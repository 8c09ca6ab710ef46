"""Text normalisation.

Python's ``\\w`` and ``\\s`` are Unicode-aware; Java regexes need ``(?U)`` and
explicit classes to match them (without it ``limón`` would lose its accent). ``F.trim`` only strips
spaces, so stripping uses a whitespace regex."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cosecha._util import col

# Python's classes: letters, numbers of every kind and the underscore are word
# characters (combining marks are not); the four separators \x1c-\x1f are space
_WS = r"[\s\x1c-\x1f]"
_EDGE_WS = rf"(?U)^{_WS}+|{_WS}+$"
_PUNCT = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]"
_WS_RUN = rf"(?U){_WS}+"


def strip_ws(c) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col(c), _EDGE_WS, "")


def remove_punct(c) -> Column:
    """``str.replace(r'[^\\w\\s]', '')``."""
    return F.regexp_replace(col(c), _PUNCT, "")


def collapse_ws(c) -> Column:
    """``str.replace(r'\\s+', ' ')``."""
    return F.regexp_replace(col(c), _WS_RUN, " ")


def normalize_text(c) -> Column:
    """lower -> strip -> drop punctuation -> collapse whitespace runs."""
    return collapse_ws(remove_punct(strip_ws(F.lower(col(c)))))


def space_to_underscore(c) -> Column:
    """``str.strip().str.replace(' ', '_')`` (literal, not regex)."""
    return F.replace(strip_ws(c), F.lit(" "), F.lit("_"))


def table_name_from_file(c, prefix: str = "", suffix: str = ".csv") -> Column:
    """File name -> table name: remove ``suffix`` (every occurrence, like
    ``str.replace``), upper-case, add a prefix (``food.csv`` -> ``FDC_FOOD``)."""
    base = F.upper(F.replace(col(c), F.lit(suffix), F.lit("")))
    return F.concat(F.lit(prefix), base) if prefix else base


def table_name(file_name: str, prefix: str = "", suffix: str = ".csv") -> str:
    """The same rule for a single (driver-side) manifest entry."""
    return prefix + file_name.replace(suffix, "").upper()
