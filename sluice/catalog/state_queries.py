"""Pipeline-state queries (ST-1..ST-9, JN-3) over a registry derived from
supplier ⋈ nation ⋈ region: one managed table per supplier
(``supplier_<key>``), its schema the supplier's region, readiness /
backfill / dependency derived from the supplier key.  The registry and the
state grow with the supplier table, so every query here scales with the
data like the rest of the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog.registry import query, table
from sluice.operators import state as S
from sluice.session import shared_dir

_REG_SQL = """reg AS (
  SELECT 'supplier_' || CAST(s.s_suppkey AS VARCHAR) AS table_name, lower(r.r_name) AS rschema, s.s_suppkey AS k,
         CASE WHEN s.s_suppkey % 4 = 1 AND s.s_suppkey >= 5 THEN 'supplier_' || CAST(s.s_suppkey - 5 AS VARCHAR) END
           AS dependent_table
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""
_PAIRS_SQL = """pairs AS (
  SELECT rschema AS schema, table_name FROM reg WHERE k % 3 <> 0
  UNION ALL SELECT 'archive' AS schema, table_name FROM reg WHERE k % 2 = 0)"""
_OLD_SQL = """old AS (
  SELECT rschema AS schema, table_name, TIMESTAMP '2024-01-01' + to_days(CAST(k AS INTEGER)) AS last_extracted_time,
         CAST(NULL AS TIMESTAMP) AS last_successful_load_time, 'idle' AS etl_status, k % 4 = 0 AS backfill, 'v1.0' AS etl_version
  FROM reg WHERE k % 2 = 0
  UNION ALL
  SELECT 'archive' AS schema, table_name, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * CAST(k AS INTEGER),
         CAST(NULL AS TIMESTAMP), 'idle', k % 8 = 2, 'v1.0'
  FROM reg WHERE k % 4 = 2)"""
_SEEDED_SQL = """seeded AS (
  SELECT * FROM old UNION ALL
  SELECT p.schema, p.table_name, CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), 'idle', true, 'v1.0' FROM pairs p
  WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.schema = p.schema AND o.table_name = p.table_name))"""
WITH_SEEDED = f"WITH {_REG_SQL},\n{_PAIRS_SQL},\n{_OLD_SQL},\n{_SEEDED_SQL}"
_T0 = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"


def _supplier_table(k):
    return F.concat(F.lit("supplier_"), k.cast("string"))


def registry(spark, sf):
    s, n, r = table(spark, sf, "supplier"), table(spark, sf, "nation"), table(spark, sf, "region")
    k = F.col("s_suppkey")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        _supplier_table(k).alias("table_name"),
        F.create_map(F.lower("r_name"), k % 3 != 0, F.lit("archive"), k % 2 == 0).alias("ready"),
        F.when((k % 4 == 1) & (k >= 5), _supplier_table(k - 5)).alias("dependent_table"),
        F.lower("r_name").alias("rschema"), k.alias("k")))


def kept(spark, df, name):
    """Written once and read back, for a frame that a query uses several times."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def old_state(spark, sf, reg=None):
    reg = registry(spark, sf) if reg is None else reg
    k = F.col("k")
    common = [F.lit(None).cast("timestamp_ntz").alias("last_successful_load_time"), F.lit("idle").alias("etl_status")]
    own = reg.where(k % 2 == 0).select(
        F.col("rschema").alias("schema"), "table_name",
        F.timestamp_add("DAY", k, F.expr(_T0)).alias("last_extracted_time"), *common,
        (k % 4 == 0).alias("backfill"), F.lit("v1.0").alias("etl_version"))
    archive = reg.where(k % 4 == 2).select(
        F.lit("archive").alias("schema"), "table_name",
        F.timestamp_add("HOUR", k, F.expr(_T0)).alias("last_extracted_time"), *common,
        (k % 8 == 2).alias("backfill"), F.lit("v1.0").alias("etl_version"))
    return own.unionByName(archive)


def seeded(spark, sf, reg=None):
    reg = registry(spark, sf) if reg is None else reg
    return S.seed_state(old_state(spark, sf, reg), S.ready_pairs(reg))


@query("ready_tables", sql=f"WITH {_REG_SQL},\n{_PAIRS_SQL} SELECT * FROM pairs")
def ready_tables(spark, sf):
    """ST-6: (schema, table) pairs whose ready flag is true."""
    return S.ready_pairs(registry(spark, sf))


@query("state_seed", sql=f"{WITH_SEEDED} SELECT * FROM seeded")
def state_seed(spark, sf):
    """ST-1 + ST-2: existing state plus default rows for new ready pairs."""
    return seeded(spark, sf)


@query("state_lookup", sql=f"""{WITH_SEEDED}
    SELECT schema, table_name, last_extracted_time FROM seeded WHERE schema = 'archive' AND table_name = 'supplier_2'""")
def state_lookup(spark, sf):
    """ST-3: one table's bookmark."""
    return S.lookup(seeded(spark, sf), "archive", "supplier_2").select("schema", "table_name", "last_extracted_time")


@query("state_mode", sql=f"""{WITH_SEEDED}
    SELECT schema, table_name, CASE WHEN backfill THEN 'backfill' ELSE 'incremental' END AS mode FROM seeded""")
def state_mode(spark, sf):
    """ST-5: run mode per table."""
    return S.with_mode(seeded(spark, sf)).select("schema", "table_name", "mode")


def _eligible_sql(flag: str) -> str:
    return f"""{WITH_SEEDED}
    SELECT p.schema, p.table_name FROM pairs p
    JOIN seeded s ON s.schema = p.schema AND s.table_name = p.table_name
    LEFT JOIN reg g ON g.table_name = p.table_name
    LEFT JOIN seeded d ON d.schema = p.schema AND d.table_name = g.dependent_table
    WHERE NOT (g.dependent_table IS NOT NULL AND COALESCE(d.backfill, false)) AND s.backfill = {flag}"""


def _eligible(spark, sf, mode):
    reg = kept(spark, registry(spark, sf), "registry")
    state = kept(spark, seeded(spark, sf, reg), "state")
    return S.eligible_tables(S.ready_pairs(reg), state, reg, mode)


@query("eligible_backfill", sql=_eligible_sql("true"))
def eligible_backfill(spark, sf):
    """ST-7 / JN-3 in backfill mode."""
    return _eligible(spark, sf, "backfill")


@query("eligible_incremental", sql=_eligible_sql("false"))
def eligible_incremental(spark, sf):
    """ST-7 / JN-3 in incremental mode."""
    return _eligible(spark, sf, "incremental")


_UPD_SQL = """upd AS (
  SELECT lower(r.r_name) AS schema, 'supplier_' || CAST(s.s_suppkey AS VARCHAR) AS table_name,
         CASE WHEN s.s_suppkey % 7 = 0 THEN 'running' ELSE 'idle' END AS etl_status,
         CASE WHEN s.s_suppkey % 7 = 0 THEN NULL ELSE l.max_version END AS extracted_time,
         CASE WHEN s.s_suppkey % 7 = 0 THEN NULL ELSE TIMESTAMP '2024-02-01 10:20:30.123' END AS loaded_time,
         l.batch_rows < 600 AS remove_backfill
  FROM (SELECT l_suppkey, max(l_shipdate) AS max_version, count(*) AS batch_rows FROM lineitem GROUP BY l_suppkey) l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@query("state_update", sql=f"""{WITH_SEEDED},
    {_UPD_SQL}
    SELECT s.schema, s.table_name,
      COALESCE(u.extracted_time, s.last_extracted_time) AS last_extracted_time,
      COALESCE(date_trunc('millisecond', u.loaded_time), s.last_successful_load_time) AS last_successful_load_time,
      COALESCE(u.etl_status, s.etl_status) AS etl_status,
      CASE WHEN COALESCE(u.remove_backfill, false) THEN false ELSE s.backfill END AS backfill, s.etl_version
    FROM seeded s LEFT JOIN upd u ON s.schema = u.schema AND s.table_name = u.table_name""")
def state_update(spark, sf):
    """ST-4 (bulk, including status-only updates) + ST-9: per supplier table,
    its newest line item becomes the bookmark; small batches leave backfill.
    Line items are aggregated per supplier first (partial aggregation), then
    joined to the one-row-per-supplier dimensions."""
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    per_supp = li.groupBy("l_suppkey").agg(F.max("l_shipdate").alias("max_version"),
                                           F.count(F.lit(1)).alias("batch_rows"))
    per = (per_supp.join(s, per_supp.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
           .join(r, n.n_regionkey == r.r_regionkey)
           .select(F.lower("r_name").alias("schema"), _supplier_table(F.col("s_suppkey")).alias("table_name"),
                   "s_suppkey", "max_version", "batch_rows"))
    running = F.col("s_suppkey") % 7 == 0
    upd = per.select(
        "schema", "table_name", F.when(running, F.lit("running")).otherwise(F.lit("idle")).alias("etl_status"),
        F.when(~running, F.col("max_version")).alias("extracted_time"),
        F.when(~running, F.expr("TIMESTAMP_NTZ '2024-02-01 10:20:30.123'")).alias("loaded_time"),
        (F.col("batch_rows") < 600).alias("remove_backfill"))
    return S.update_state(seeded(spark, sf), upd)


@query("watermark_advance", sql="""
    WITH st AS (SELECT DISTINCT event_type AS table_name FROM events UNION ALL SELECT DISTINCT event_type || '_archive' FROM events),
    mx AS (SELECT event_type, max(ts) AS m FROM events GROUP BY 1)
    SELECT 'events' AS schema, st.table_name, mx.m AS last_extracted_time,
           TIMESTAMP '2024-02-01 00:00:00' AS last_successful_load_time, 'idle' AS etl_status, true AS backfill,
           'v1.0' AS etl_version
    FROM st LEFT JOIN mx ON st.table_name = mx.event_type""")
def watermark_advance(spark, sf):
    """ST-8 (+ AG-3): each table's bookmark becomes its batch's max version;
    a table whose batch is empty (the archives) only moves its load time."""
    e = table(spark, sf, "events")
    maxima = kept(spark, e.groupBy(F.col("event_type").alias("table_name")).agg(F.max("ts").alias("max_version")), "maxima")
    names = maxima.select(F.explode(F.array("table_name", F.concat("table_name", F.lit("_archive")))).alias("table_name"))
    state = S.seed_state(S.empty_state(spark), names.select(F.lit("events").alias("schema"), "table_name"))
    per_table = state.select("schema", "table_name").join(maxima, "table_name", "left")
    return S.update_state(state, S.watermark_updates(per_table, "2024-02-01 00:00:00"))
