"""Enrichment join queries (JN-1, JN-2, PF-10, DX-9, SRC-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog.registry import query, table
from sluice.operators.joins import enrich, enrich_from
from sluice.session import shared_dir
from sluice.sources import warehouse as W

_O = "o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority"
_C = "c.c_name AS customer__c_name, c.c_mktsegment AS customer__c_mktsegment"


# Whole tables; the keys of every fifth customer and of every fourth customer's orders are moved, so both sides miss some.
_C_KEY = "CASE WHEN c_custkey % 5 = 0 THEN -c_custkey ELSE c_custkey END"
_O_KEY = "CASE WHEN o_custkey % 4 = 0 THEN -1 - o_custkey ELSE o_custkey END"
_CMOVED = f"(SELECT *, {_C_KEY} AS c_key FROM customer)"
_OMOVED = f"(SELECT * REPLACE ({_O_KEY} AS o_custkey) FROM orders)"


def _customers(spark, sf):
    return table(spark, sf, "customer").withColumn("c_key", F.expr(_C_KEY))


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("o_custkey", F.expr(_O_KEY))


def _enriched(spark, sf, left, how):
    return enrich(left, _customers(spark, sf), "customer", "o_custkey", "c_key", how=how, right_columns=["c_name", "c_mktsegment"])


@query("enrich_inner", sql=f"SELECT {_O}, {_C} FROM orders o JOIN {_CMOVED} c ON o.o_custkey = c.c_key")
def enrich_inner(spark, sf):
    return _enriched(spark, sf, table(spark, sf, "orders"), "inner")


@query("enrich_left", sql=f"SELECT {_O}, {_C} FROM orders o LEFT JOIN {_CMOVED} c ON o.o_custkey = c.c_key")
def enrich_left(spark, sf):
    return _enriched(spark, sf, table(spark, sf, "orders"), "left")


@query("enrich_right", sql=f"SELECT {_O}, {_C} FROM {_OMOVED} o RIGHT JOIN {_CMOVED} c ON o.o_custkey = c.c_key")
def enrich_right(spark, sf):
    return _enriched(spark, sf, _orders(spark, sf), "right")


@query("enrich_full", sql=f"SELECT {_O}, {_C} FROM {_OMOVED} o FULL JOIN {_CMOVED} c ON o.o_custkey = c.c_key")
def enrich_full(spark, sf):
    return _enriched(spark, sf, _orders(spark, sf), "full")


@query("enrich_semi", sql=f"SELECT * FROM customer c WHERE EXISTS (SELECT 1 FROM {_OMOVED} o WHERE o.o_custkey = c.c_custkey)")
def enrich_semi(spark, sf):
    return enrich(table(spark, sf, "customer"), _orders(spark, sf), "orders", "c_custkey", "o_custkey", how="left_semi")


@query("enrich_anti", sql=f"SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM {_OMOVED} o WHERE o.o_custkey = c.c_custkey)")
def enrich_anti(spark, sf):
    return enrich(table(spark, sf, "customer"), _orders(spark, sf), "orders", "c_custkey", "o_custkey", how="left_anti")


@query("enrich_filter_rows", sql="""
    SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_custkey % 5 AS region_hint, n.n_name AS nation__n_name
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE c.c_custkey % 5 = n.n_regionkey""")
def enrich_filter_rows(spark, sf):
    """PF-10: keep joined rows whose left column equals a right column."""
    left = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey",
                                               (F.col("c_custkey") % 5).alias("region_hint"))
    return enrich(left, table(spark, sf, "nation"), "nation", "c_nationkey", "n_nationkey", how="left",
                  right_columns=["n_name"], filter_rows={"region_hint": "n_regionkey"})


@query("replace_columns", sql="""
    SELECT c.c_custkey, COALESCE(n.n_name, c.c_mktsegment) AS c_mktsegment, c.c_custkey % 30 AS nk,
           n.n_regionkey AS nation__n_regionkey
    FROM customer c LEFT JOIN nation n ON c.c_custkey % 30 = n.n_nationkey""")
def replace_columns(spark, sf):
    """DX-9: a left column replaced by the right value where one exists."""
    left = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", (F.col("c_custkey") % 30).alias("nk"))
    return enrich(left, table(spark, sf, "nation"), "nation", "nk", "n_nationkey", how="left",
                  right_columns=["n_regionkey"], replace_columns={"c_mktsegment": "n_name"})


@query("enrich_multikey", sql="""
    SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_quantity, s.s_name AS supplier__s_name
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey AND l.l_suppkey % 7 = s.s_nationkey % 7""")
def enrich_multikey(spark, sf):
    """JN-1 with two key pairs (extension)."""
    left = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                               (F.col("l_suppkey") % 7).alias("k7"))
    right = table(spark, sf, "supplier").withColumn("k7", (F.col("s_nationkey") % 7).cast("bigint"))
    out = enrich(left, right, "supplier", ["l_suppkey", "k7"], ["s_suppkey", "k7"], how="inner",
                 right_columns=["s_name"])
    return out.drop("k7")


@query("enrich_from_warehouse", sql=f"""
    SELECT {_O}, c.c_name AS customer__c_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def enrich_from_warehouse(spark, sf):
    """JN-2 + SRC-6: a registry join block whose right side is read from the
    curated warehouse table (committed as a version first)."""
    root = shared_dir(spark, "warehouse-customer")
    W.commit_next(spark, table(spark, sf, "customer"), root)

    def resolver(name, from_warehouse):
        if from_warehouse:
            return W.read_table(spark, root)
        return table(spark, sf, name)

    conf = {"with_table": "customer", "how": "left", "left": "o_custkey", "right": "c_custkey",
            "right_table_columns": ["c_name"], "clickhouse": True}
    return enrich_from(resolver, table(spark, sf, "orders"), conf)


_HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_orderkey END"


@query("enrich_hot_key", sql=f"""
    SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.order_ref, o.o_orderstatus AS orders__o_orderstatus,
           o.o_orderdate AS orders__o_orderdate
    FROM (SELECT l_orderkey, l_linenumber, l_quantity, {_HOT} AS order_ref FROM lineitem) l
    LEFT JOIN orders o ON l.order_ref = o.o_orderkey""")
def enrich_hot_key(spark, sf):
    """JN-1 with one key holding a third of the left rows: the hot key is
    found by a partial aggregate and spread over 16 salted join tasks; the
    result equals the plain left join."""
    left = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_quantity", f"{_HOT} AS order_ref")
    return enrich(left, table(spark, sf, "orders"), "orders", "order_ref", "o_orderkey", how="left",
                  right_columns=["o_orderstatus", "o_orderdate"], salt_buckets=16, hot_key_rows=1000)


_HOT_OR_NONE = "CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey END"
_HOT_SQL = f"""
    SELECT l.l_orderkey, l.l_linenumber, l.order_ref, o.o_orderkey AS orders__o_orderkey, o.o_orderstatus AS orders__o_orderstatus
    FROM (SELECT l_orderkey, l_linenumber, {_HOT_OR_NONE} AS order_ref FROM lineitem) l
    {{}} JOIN orders o ON l.order_ref = o.o_orderkey"""


def _hot_outer(spark, sf, how):
    left = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_HOT_OR_NONE} AS order_ref")
    return enrich(left, table(spark, sf, "orders"), "orders", "order_ref", "o_orderkey", how=how,
                  right_columns=["o_orderkey", "o_orderstatus"], salt_buckets=16, hot_key_rows=1000)


@query("enrich_hot_key_right", sql=_HOT_SQL.format("RIGHT"))
def enrich_hot_key_right(spark, sf):
    """JN-1, right join with a hot key and NULL keys: salted inner join and the orders that no item refers to."""
    return _hot_outer(spark, sf, "right")


@query("enrich_hot_key_full", sql=_HOT_SQL.format("FULL"))
def enrich_hot_key_full(spark, sf):
    """JN-1, full join with a hot key and NULL keys: salted left join and the orders that no item refers to."""
    return _hot_outer(spark, sf, "full")
