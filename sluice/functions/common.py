"""Small expression helpers shared by cleaners and rule steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    """Value as trimmed text (any input type)."""
    return F.trim(as_col(c).cast("string"))


def blank_to_null(c) -> Column:
    """NULL when the trimmed value is empty, else the value itself."""
    c = as_col(c)
    return F.when(F.length(F.trim(c)) > 0, c)


def empty_to_null(c) -> Column:
    """NULL when the value is the empty string.  For values that are already
    trimmed this equals ``blank_to_null`` but evaluates ``c`` once
    (``nullif``), whereas ``when(pred(c), c)`` computes an expensive ``c``
    twice per row: subexpression elimination does not share a value branch
    with its condition."""
    return F.nullif(as_col(c), F.lit(""))


def ts_literal(value: str, dtype: str = "timestamp_ntz") -> Column:
    """A typed timestamp literal (folded by Catalyst, so it reaches scans)."""
    kw = "TIMESTAMP_NTZ" if dtype == "timestamp_ntz" else "TIMESTAMP"
    return F.expr(f"{kw} '{value}'")
