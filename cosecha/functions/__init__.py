"""Column-level helpers: every function takes and returns ``Column`` objects
built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen."""

from cosecha.functions.arith import fill0, fill, safe_div, null_if, round_half_even
from cosecha.functions.text import (normalize_text, strip_ws, remove_punct, collapse_ws,
                                    space_to_underscore, table_name_from_file)
from cosecha.functions.recode import recode_map, recode_replace, replace_values

__all__ = [
    "fill0", "fill", "safe_div", "null_if", "round_half_even",
    "normalize_text", "strip_ws", "remove_punct", "collapse_ws", "space_to_underscore",
    "table_name_from_file", "recode_map", "recode_replace", "replace_values",
]
