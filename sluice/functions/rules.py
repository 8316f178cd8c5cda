"""Column expressions behind the declarative rule steps (TR-1..TR-7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType

from sluice.functions.common import as_col, empty_to_null


def one_to_zero(c) -> Column:
    """TR-1: 1 -> 0, anything else unchanged."""
    c = as_col(c)
    return F.when(c == 1, F.lit(0)).otherwise(c)


def initcap(c) -> Column:
    """TR-2: initcap without trimming (words split on spaces only)."""
    return F.initcap(as_col(c))


def yn_to_boolean(c) -> Column:
    """TR-3: trimmed y/n in any case -> true/false, anything else NULL."""
    s = F.lower(F.trim(as_col(c).cast("string")))
    return F.when(s == "y", F.lit(True)).when(s == "n", F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def upper_trim(c) -> Column:
    """TR-4: trim then upper-case."""
    return F.upper(F.trim(as_col(c)))


def zero_to_null(c, dtype: DataType | None = None) -> Column:
    """TR-5: numeric zero, or text that is blank / '0' / numerically zero -> NULL.

    On text the numeric test is ``try_cast(decimal(38,18)) == 0`` so '0.0' and
    '00' become NULL, '0.4' and 'abc' stay (documented deviation D2: the
    reference relied on a non-ANSI implicit cast).
    """
    c = as_col(c)
    if dtype is not None and not isinstance(dtype, StringType):
        return F.when(c == 0, F.lit(None)).otherwise(c)
    s = F.trim(c.cast("string"))
    zero = (s.try_cast(DecimalType(38, 18)) == 0) | s.isin("0", "")
    return F.when(zero, F.lit(None).cast("string")).otherwise(c)


def trim_blank_to_null(c) -> Column:
    """TR-6 (per string column): trimmed value, '' -> NULL (trimmed once)."""
    return empty_to_null(F.trim(as_col(c)))


def round_decimal(c, scale: int, precision: int = 10) -> Column:
    """TR-7: HALF_UP round to ``scale`` then decimal(precision, scale);
    overflow gives NULL (``try_cast``) instead of an ANSI error."""
    return F.round(as_col(c), scale).try_cast(DecimalType(precision, scale))
