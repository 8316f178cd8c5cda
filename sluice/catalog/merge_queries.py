"""Merge, dedup, landing and conformance queries (SNK-1..6, AG-4, AG-5,
SO-1, SRC-5, SRC-6, QA-3, PF-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog.dirty import dirty_customer, dirty_customer_sql
from sluice.catalog.registry import query, table
from sluice.operators import merge as M
from sluice.session import shared_dir
from sluice.sources import clean as C
from sluice.sources import curated as K
from sluice.sources import landing as L

EV_COLS = "event_id, ts, user_id, event_type, value, props"
_DESC = "ts DESC NULLS LAST, p DESC, event_id DESC NULLS LAST, event_type DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST"


@query("merge_latest", sql=f"""
    SELECT {EV_COLS} FROM (
      SELECT {EV_COLS}, 0 AS p FROM events WHERE ts < TIMESTAMP '2024-01-20'
      UNION ALL
      SELECT event_id, ts, user_id, event_type, value * 2 AS value, props, 1 AS p FROM events
      WHERE ts >= TIMESTAMP '2024-01-15')
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {_DESC}) = 1""")
def merge_latest(spark, sf):
    """SNK-4 + SO-1: curated (events before the 20th) merged with an
    overlapping batch (from the 15th, values changed); key user_id, version ts."""
    e = table(spark, sf, "events")
    current = e.where(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'"))
    incoming = e.where(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")).withColumn("value", F.col("value") * 2)
    return M.merge_latest(current, incoming, key="user_id", version="ts")


_REPLAY_SQL = """
    SELECT event_id, ts, user_id, event_type, value,
           CASE WHEN event_type IN ('click', 'purchase') THEN 'v2' ELSE props END AS props
    FROM events"""


def _replay_batch(e):
    same_ts = e.where(F.col("event_type").isin("click", "purchase")).withColumn("props", F.lit("v2"))
    older = e.where(F.col("event_type") == "error").withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 DAY"))
    return same_ts.unionByName(older)


@query("merge_incremental", sql=_REPLAY_SQL)
def merge_incremental(spark, sf):
    """SNK-4 into a stored table that is one row per key (events by
    event_id): only the keys the batch touches are merged; the other rows
    pass through a broadcast anti join, so the table is never shuffled."""
    e = table(spark, sf, "events")
    return M.merge_latest(e, _replay_batch(e), key="event_id", version="ts", current_unique=True)


@query("merge_replay", sql=_REPLAY_SQL)
def merge_replay(spark, sf):
    """SNK-4 keyed on event_id: an equal version from the batch replaces the
    curated row (last insert wins); an older version never does; replaying
    the same batch leaves the result unchanged."""
    e = table(spark, sf, "events")
    batch = _replay_batch(e)
    once = M.merge_latest(e, batch, key="event_id", version="ts")
    return M.merge_latest(once, batch, key="event_id", version="ts")


_NULLED = f"""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts, user_id, event_type, value, props
    FROM events"""


@query("dedup_latest", sql=f"""
    SELECT {EV_COLS} FROM ({_NULLED}) WHERE ts IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC,
                                value DESC, props DESC) = 1""")
def dedup_latest(spark, sf):
    """AG-5 after PF-7: NULL versions are dropped first, then the latest row
    per key survives (deterministically)."""
    e = table(spark, sf, "events").selectExpr(*[c.strip() for c in
        "event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts, user_id, event_type, value, props".split(", ")])
    return M.latest_per_key(e, key="user_id", version="ts")


@query("required_timestamps", sql="""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate END IS NOT NULL
      AND CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END IS NOT NULL""")
def required_timestamps(spark, sf):
    """PF-7: rows need both created and updated timestamps."""
    from sluice.plans.run import require_timestamps

    o = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderdate", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate END AS created_at",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS updated_at")
    return require_timestamps(o).select("o_orderkey", "o_orderdate")


_STAGED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate - INTERVAL 30 YEAR AS o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey % 3 <> 0"""
_STAGED_LATER = """
    SELECT o_orderkey, o_custkey, 'R' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
           CASE o_orderkey % 3 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate - INTERVAL 30 YEAR
                ELSE o_orderdate - INTERVAL 31 YEAR END AS o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey % 2 = 0"""


@query("curated_load", sql=f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(0 AS BIGINT) AS staged_left
    FROM (SELECT *, 0 AS p FROM ({_STAGED}) UNION ALL SELECT *, 1 FROM ({_STAGED_LATER}))
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, p DESC) = 1""")
def curated_load(spark, sf):
    """SNK-3 / AG-4: two staged batches go into one keyed table, the second
    into the filled one; each arrives twice (a retried append) and is emptied
    after its load.  Versions lie around 1970; of the second batch's keys a
    third are new, a third have an equal version (they win) and a third an
    older one (they lose)."""
    o = table(spark, sf, "orders")
    o.createOrReplaceTempView("sluice_staged_orders")
    root, staged = shared_dir(spark, "curated-orders"), shared_dir(spark, "staged-orders")
    for text in (_STAGED, _STAGED_LATER):
        rows = spark.sql(text.replace("FROM orders", "FROM sluice_staged_orders"))
        rows.unionByName(rows).write.mode("overwrite").parquet(staged)
        K.load_staged(spark, staged, root, key="o_orderkey", version="o_orderdate")
    left = spark.read.parquet(staged).agg(F.count(F.lit(1)).alias("staged_left"))
    return K.read(spark, root).crossJoin(F.broadcast(left))  # one row


_REJECTS = {"id": "bigint", "latitude": "float", "customer_nik": "decimal(16,0)", "c_acctbal": "decimal(6,2)", "deleted": "boolean"}


@query("clean_layer", sql=f"""
    WITH d AS (SELECT id, latitude, customer_nik, c_acctbal, TRY_CAST(latitude AS FLOAT) AS la,
                      TRY_CAST(customer_nik AS DECIMAL(16,0)) AS ni, TRY_CAST(c_acctbal AS DECIMAL(6,2)) AS ac
               FROM {dirty_customer_sql()} d),
    f AS (SELECT id, 'latitude' AS column_name, latitude AS raw_value FROM d WHERE latitude IS NOT NULL AND la IS NULL
          UNION ALL SELECT id, 'customer_nik', customer_nik FROM d WHERE customer_nik IS NOT NULL AND ni IS NULL
          UNION ALL SELECT id, 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM d WHERE c_acctbal IS NOT NULL AND ac IS NULL)
    SELECT 'clean' AS side, NULL AS column_name, NULL AS raw_value, count(*) AS row_count FROM d WHERE id NOT IN (SELECT id FROM f)
    UNION ALL SELECT 'rejected', NULL, NULL, count(DISTINCT id) FROM f
    UNION ALL SELECT 'value', column_name, raw_value, count(*) FROM f WHERE column_name <> 'c_acctbal' GROUP BY 2, 3
    UNION ALL SELECT 'value', column_name, NULL, count(*) FROM f WHERE column_name = 'c_acctbal' GROUP BY 2""")
def clean_layer(spark, sf):
    """SNK-2: dirty customers written once to the clean layer: rows on each
    side, and the rejected values with the column whose type they do not fit
    (balances by number only)."""
    d = dirty_customer(spark, sf).select(*_REJECTS)
    root = shared_dir(spark, "clean-layer")
    C.write(spark, d, root, "first", _REJECTS)
    sides = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("side"), F.lit(None).cast("string").alias("column_name"),
                                                              F.lit(None).cast("string").alias("raw_value"), "row_count")
             for n, df in (("clean", C.read(spark, root, "first")), ("rejected", C.rejected(spark, root, "first")))]
    values = C.rejected(spark, root, "first").select(F.explode("failed_values").alias("f")).select(
        "f.column_name", F.when(F.col("f.column_name") != "c_acctbal", F.col("f.raw_value")).alias("raw_value"))
    counted = values.groupBy("column_name", "raw_value").agg(F.count(F.lit(1)).alias("row_count"))
    return sides[0].unionByName(sides[1]).unionByName(counted.select(F.lit("value").alias("side"), "column_name", "raw_value", "row_count"))


@query("landing_roundtrip", sql="SELECT event_id, ts, user_id, value, props, event_type, 7 AS batch_id FROM events")
def landing_roundtrip(spark, sf):
    """SNK-1 + SRC-5: a batch written twice (a retry) under batch_id=7,
    partitioned by event_type, then read back whole."""
    e = table(spark, sf, "events")
    root = shared_dir(spark, "landing-events")
    L.write_landing(e, root, 7, partition_by="event_type")
    L.write_landing(e, root, 7, partition_by="event_type")
    return L.read_landing(spark, root)


@query("landing_partition_scan", sql="SELECT event_id, ts, user_id, value, props, event_type FROM events WHERE event_type = 'click'")
def landing_partition_scan(spark, sf):
    """SRC-5 with a partition: only the event_type=click directory is read."""
    e = table(spark, sf, "events")
    root = shared_dir(spark, "landing-part")
    L.write_landing(e, root, 1, partition_by="event_type")
    return L.read_landing(spark, root, "event_type", "click").drop("batch_id")


@query("staging_reset", sql="SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM events")
def staging_reset(spark, sf):
    """SNK-5 / SNK-6: reset a staged table, with before/after counts."""
    e = table(spark, sf, "events")
    path = shared_dir(spark, "staging-reset")
    e.write.mode("overwrite").parquet(path)
    before = spark.read.parquet(path).count()  # one scalar
    L.reset(e, path)
    after = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_after"))
    return after.select(F.lit(before).cast("bigint").alias("rows_before"), "rows_after")


_LI_DDL = ("l_orderkey bigint, l_linenumber smallint, l_quantity decimal(10,2), l_extendedprice decimal(10,2), "
           "l_shipdate date, l_returnflag string")


@query("clean_conform", sql="""
    SELECT l_orderkey, TRY_CAST(l_linenumber AS SMALLINT) AS l_linenumber, TRY_CAST(l_quantity AS DECIMAL(10,2)) AS l_quantity,
           TRY_CAST(l_extendedprice AS DECIMAL(10,2)) AS l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate,
           l_returnflag FROM lineitem""")
def clean_conform(spark, sf):
    """SNK-2: project and cast to the declared clean-table schema."""
    return M.conform(table(spark, sf, "lineitem"), _LI_DDL)


_DECL = {"id": "bigint", "latitude": "float", "longitude": "float", "customer_nik": "decimal(20,0)",
         "deleted": "boolean", "c_acctbal": "decimal(6,2)", "missing_col": "string"}


@query("conform_violations", sql=f"""
    SELECT * FROM (VALUES ('id', 'ok', 'bigint', 0), ('missing_col', 'missing', 'string', NULL)) t(column_name, status, declared_type, failed_casts)
    UNION ALL
    SELECT 'latitude', 'ok', 'float', count(*) FILTER (WHERE latitude IS NOT NULL AND TRY_CAST(latitude AS FLOAT) IS NULL) FROM {dirty_customer_sql()}
    UNION ALL
    SELECT 'longitude', 'ok', 'float', count(*) FILTER (WHERE longitude IS NOT NULL AND TRY_CAST(longitude AS FLOAT) IS NULL) FROM {dirty_customer_sql()}
    UNION ALL
    SELECT 'customer_nik', 'ok', 'decimal(20,0)', count(*) FILTER (WHERE customer_nik IS NOT NULL AND TRY_CAST(customer_nik AS DECIMAL(20,0)) IS NULL) FROM {dirty_customer_sql()}
    UNION ALL
    SELECT 'deleted', 'ok', 'boolean', 0
    UNION ALL
    SELECT 'c_acctbal', 'ok', 'decimal(6,2)', count(*) FILTER (WHERE c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DECIMAL(6,2)) IS NULL) FROM customer
    UNION ALL
    SELECT 'city', 'extra', NULL, NULL""")
def conform_violations(spark, sf):
    """QA-3: per declared column, how many values fail the declared type;
    missing declared columns and undeclared extra columns are listed."""
    d = dirty_customer(spark, sf).select("id", "latitude", "longitude", "customer_nik", "deleted", "c_acctbal", "city")
    return M.conform_violations(d, _DECL)


@query("landing_eligible_batches", sql="""
    SELECT event_id, ts, user_id, event_type, value, event_type || '-' || CAST(day(ts) % 6 AS VARCHAR) AS batch_id
    FROM events WHERE event_type NOT IN ('click', 'error')""")
def landing_eligible_batches(spark, sf):
    """SRC-5 with ST-7: of all landed batches those of the tables that may run
    incrementally now ('click' is in backfill, 'error' depends on it); the ids
    choose the folders that are read."""
    from sluice.operators import state as S

    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", F.concat_ws(
        "-", "event_type", (F.dayofmonth("ts") % 6).cast("string")).alias("batch_id"))
    root = shared_dir(spark, "landing-eligible")
    e.write.partitionBy("batch_id").parquet(root)
    kinds = e.select(F.col("event_type").alias("table_name")).distinct()
    pairs = kinds.select(F.lit("events").alias("schema"), "table_name")
    state = S.seed_state(S.empty_state(spark), pairs).withColumn("backfill", F.col("table_name") == "click")
    registry = kinds.withColumn("dependent_table", F.when(F.col("table_name") == "error", F.lit("click")))
    eligible = S.eligible_tables(pairs, state, registry, "incremental")
    batches = e.select("batch_id", F.col("event_type").alias("table_name")).distinct().join(eligible, "table_name")
    return L.read_batches(spark, root, batches)
