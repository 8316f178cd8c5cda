"""Invoice-line repair expressions (documented extras DX-1..DX-7).

Divisions use ``try_divide`` so a zero denominator gives NULL, never an
error, whatever the session's ANSI setting.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.common import as_col


def _sum(cols: Sequence) -> Column:
    return reduce(lambda a, b: a + b, [as_col(c) for c in cols])


def scale_down(c, threshold: float, divisor: float) -> Column:
    """DX-1: values above ``threshold`` are divided by ``divisor``
    (convert_scale_100: 5 / 100; convert_scale_1000: 25 / 1000)."""
    c = as_col(c)
    return F.when(c > threshold, c / divisor).otherwise(c)


def discount_percent_fix(discount, amount, qty_sold, price, conversion, limit: float = 80) -> Column:
    """DX-2: a discount percent above ``limit`` that equals its amount (at 2
    decimals) is recomputed as ``100 * amount / (qty_sold * price /
    conversion)``; every result is rounded to 2 decimals."""
    d = as_col(discount)
    base = F.try_divide(as_col(qty_sold) * as_col(price), as_col(conversion))
    fixed = F.round(F.try_divide(100 * d, base), 2)
    return F.when((d > limit) & (F.round(d, 2) == F.round(as_col(amount), 2)), fixed).otherwise(F.round(d, 2))


def discount_base(gross, amounts: Sequence) -> Column:
    """DX-3: gross minus the sum of the discount amounts."""
    return as_col(gross) - _sum(amounts)


def true_conversion(price, amounts: Sequence, discount_base_col, qty_order) -> Column:
    """DX-4: price / ((sum(amounts) + discount base) / qty_order) when
    qty_order is non-zero, else NULL."""
    q = as_col(qty_order)
    per_unit = F.try_divide(_sum(amounts) + as_col(discount_base_col), q)
    return F.when(q != 0, F.try_divide(as_col(price), per_unit))


def net_with_tax(net, taxes: Sequence) -> Column:
    """DX-5: net amount plus the tax amounts."""
    return as_col(net) + _sum(taxes)


def impute_when_missing(target, gross, numerator, denominator) -> Column:
    """DX-6 / DX-7: when ``target`` is 0 or NULL and gross and denominator
    are present and non-zero, ``gross * numerator / denominator``."""
    t, g, n, d = as_col(target), as_col(gross), as_col(numerator), as_col(denominator)
    missing = (t == 0) | t.isNull()
    ok = g.isNotNull() & (g != 0) & d.isNotNull() & (d != 0)
    return F.when(missing & ok, F.try_divide(g * n, d)).otherwise(t)
