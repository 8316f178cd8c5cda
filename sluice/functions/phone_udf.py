"""Optional exact phone validation through a user-supplied validator (D7).

The default validity check is a native column predicate
(``cleaners.phone_is_valid``).  When exact parity with a phone-number
library is required, wrap its validator here: the function runs on Arrow
batches (a pandas Series per batch), never row by row through pickling.
No phone library is bundled; pass your own ``validator(str) -> bool``.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf


def vectorized_validator(validator: Callable[[str], bool]) -> Callable[[Column], Column]:
    """Column -> boolean Column; NULL / empty / raising inputs are False."""

    def safe(v):
        if v is None or v == "":
            return False
        try:
            return bool(validator(v))
        except Exception:  # noqa: BLE001 - a parse error means invalid, as in the reference
            return False

    @pandas_udf("boolean")
    def _valid(s: pd.Series) -> pd.Series:
        return s.map(safe).astype(bool)

    return _valid
