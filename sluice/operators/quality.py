"""Quality and audit (QA-1..QA-3, AG-2, AG-3, DX-8).

Counts are gathered with ``observe`` on the write that runs anyway, or with
one aggregate per question; reconciliation aggregates items per header key
first (partial aggregation, so a header with a third of all items is summed
on every map task before the shuffle) and then joins one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, name: str, *extra: Column) -> tuple[DataFrame, Observation]:
    """AG-2: attach a row count (and extra aggregates) to ``df``; read it
    with ``obs.get`` after the next action on the returned DataFrame."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), obs


def max_version(df: DataFrame, version: str = "updated_at") -> DataFrame:
    """AG-3: one row with the greatest version (NULL when empty)."""
    return df.agg(F.max(version).alias("max_version"))


def reconcile(
    items: DataFrame,
    headers: DataFrame,
    item_key: str,
    header_key: str,
    item_amount,
    header_amount,
    tolerance: float = 0.1,
) -> DataFrame:
    """DX-8: item totals vs header totals per key.

    Output: key, header_total, items_total, item_rows, difference, status in
    {'match', 'mismatch', 'missing_items', 'orphan_items'}; ``match`` when
    ``abs(header - items) <= tolerance``.
    """
    amt = F.col(item_amount) if isinstance(item_amount, str) else item_amount
    hamt = F.col(header_amount) if isinstance(header_amount, str) else header_amount
    totals = items.groupBy(F.col(item_key).alias("key")).agg(F.sum(amt).alias("items_total"),
                                                               F.count(F.lit(1)).alias("item_rows"))
    heads = headers.select(F.col(header_key).alias("key"), hamt.alias("header_total"))
    j = heads.join(totals, "key", "full")
    diff = F.col("header_total") - F.col("items_total")
    status = (F.when(F.col("header_total").isNull() & F.col("items_total").isNull() & F.col("item_rows").isNull(),
                     F.lit("missing_items"))
              .when(F.col("item_rows").isNull(), F.lit("missing_items"))
              .when(F.col("header_total").isNull(), F.lit("orphan_items"))
              .when(F.abs(diff) <= F.lit(tolerance), F.lit("match"))
              .otherwise(F.lit("mismatch")))
    return j.select("key", "header_total", "items_total", F.coalesce("item_rows", F.lit(0)).alias("item_rows"),
                    diff.alias("difference"), status.alias("status"))


def orphans(items: DataFrame, headers: DataFrame, item_key: str, header_key: str) -> DataFrame:
    """Items whose header key does not exist (left anti join)."""
    return items.join(headers.select(F.col(header_key).alias(item_key)), item_key, "left_anti")


def run_record(stage_counts: DataFrame, failed_after: str | None = None) -> DataFrame:
    """QA-2: one record per (schema, table_name) from per-stage counts
    (schema, table_name, extracted, cleaned, loaded): SUCCESS when the
    loaded count is present, FAILED otherwise."""
    status = F.when(F.col("loaded").isNotNull(), F.lit("SUCCESS")).otherwise(F.lit("FAILED"))
    return stage_counts.withColumn("status", status)
