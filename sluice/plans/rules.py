"""Ordered rule runner (TR-0..TR-10, PF-8, PF-9).

Each step is ``DataFrame -> DataFrame`` and touches all of its columns in a
single projection; the runner folds the steps listed in
``transformation_order`` with ``DataFrame.transform``.  A listed step with
no settings is a no-op, as in the reference; unknown steps are rejected by
``TableSpec.validate``.
"""

from __future__ import annotations

from typing import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.functions import repairs, rules
from sluice.operators.joins import enrich_from
from sluice.operators.merge import select_keep
from sluice.plans.spec import TableSpec

Resolver = Callable[[str, bool], DataFrame]


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PF-9: sequential renames; a missing source name is a no-op."""
    for old, new in mapping.items():
        df = df.withColumnRenamed(old, new)
    return df


def map_columns(df: DataFrame, cols, fn) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"rule refers to missing columns {missing}")
    return df.withColumns({c: fn(c) for c in present}) if present else df


def blank_strings_to_null(df: DataFrame) -> DataFrame:
    """TR-6: every string column trimmed, '' -> NULL (one projection)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: rules.trim_blank_to_null(c) for c in strings}) if strings else df


def zero_to_null(df: DataFrame, cols) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return map_columns(df, cols, lambda c: rules.zero_to_null(c, types[c]))


def one_to_zero(df: DataFrame, cols) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}

    def fn(c):
        if isinstance(types[c], StringType):  # compare text numerically without ANSI errors
            n = F.col(c).try_cast("decimal(38,18)")
            return F.when(n == 1, F.lit("0")).otherwise(F.col(c))
        return rules.one_to_zero(c)

    return map_columns(df, cols, fn)


def round_columns(df: DataFrame, scales: Mapping[str, int]) -> DataFrame:
    missing = [c for c in scales if c not in df.columns]
    if missing:
        raise ValueError(f"rounding refers to missing columns {missing}")
    return df.withColumns({c: rules.round_decimal(c, int(s)) for c, s in scales.items()})


def apply_rules(
    df: DataFrame,
    spec: TableSpec,
    resolver: Resolver | None = None,
    custom: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> DataFrame:
    """TR-0: run the listed steps in order."""
    from sluice.plans.recipes import CUSTOM_TRANSFORMS

    custom = dict(CUSTOM_TRANSFORMS if custom is None else custom)
    spec.validate(custom_names=custom)
    for step in spec.transformation_order:
        if not spec.configured(step):
            continue
        if step == "join":
            if resolver is None:
                raise ValueError("join step needs a table resolver")
            df = enrich_from(resolver, df, spec.join)
        elif step == "rename_columns":
            df = rename(df, spec.rename_columns)
        elif step == "convert_one_to_zero":
            df = one_to_zero(df, spec.convert_one_to_zero)
        elif step == "initcap":
            df = map_columns(df, spec.initcap, rules.initcap)
        elif step == "convert_yn_to_boolean":
            df = map_columns(df, spec.convert_yn_to_boolean, rules.yn_to_boolean)
        elif step == "keep_columns":
            df = select_keep(df, spec.keep_columns)
        elif step == "custom_table_transform":
            df = df.transform(custom[spec.custom_table_transform])
        elif step == "upper":
            df = map_columns(df, spec.upper, rules.upper_trim)
        elif step == "convert_zero_to_null":
            df = zero_to_null(df, spec.convert_zero_to_null)
        elif step == "convert_blank_to_null":
            df = blank_strings_to_null(df)
        elif step == "convert_scale_100":
            df = map_columns(df, spec.convert_scale_100, lambda c: repairs.scale_down(c, 5, 100))
        elif step == "convert_scale_1000":
            df = map_columns(df, spec.convert_scale_1000, lambda c: repairs.scale_down(c, 25, 1000))
        elif step == "rounding":
            df = round_columns(df, spec.rounding)
    return df
