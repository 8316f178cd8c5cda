"""Flagship: the minimum end-to-end slice of a batch run."""

from __future__ import annotations

from sluice.catalog.registry import query, table
from sluice.operators import batch as B
from sluice.operators.joins import enrich
from sluice.operators.merge import latest_per_key, select_keep
from sluice.session import shared_dir

KEEP = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "customer__c_name", "customer__c_mktsegment"]


def _enriched(spark, sf, rows):
    batch = latest_per_key(rows, key="o_orderkey", version="o_orderdate")
    enriched = enrich(batch, table(spark, sf, "customer"), "customer", "o_custkey", "c_custkey",
                      how="left", right_columns=["c_name", "c_mktsegment"])
    return select_keep(enriched, KEEP)


_WHOLE = """
    SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
           c.c_name AS customer__c_name, c.c_mktsegment AS customer__c_mktsegment
    FROM (SELECT * FROM orders WHERE o_orderdate IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1) o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""


@query("batch_enrich", sql=_WHOLE)
@query("batch_enrich_full", sql=_WHOLE)
def flagship_full(spark, sf, cap=B.REFERENCE_BATCH_CAP):
    """The whole table: capped batches until the orders are drained, each
    deduplicated, enriched and stored; the latest version of a key that
    several batches hold is kept."""
    orders = table(spark, sf, "orders")
    out, n = shared_dir(spark, "batch-enrich"), 0
    for n, window in enumerate(B.drain_windows(orders, "o_orderdate", cap), start=1):
        _enriched(spark, sf, window.apply(orders)).write.mode("overwrite").parquet(f"{out}/batch={n}")
    if n == 0:
        return _enriched(spark, sf, orders)
    rows = spark.read.parquet(*[f"{out}/batch={i}" for i in range(1, n + 1)])
    return latest_per_key(rows, key="o_orderkey", version="o_orderdate") if n > 1 else rows
