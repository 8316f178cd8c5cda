"""Bounded batch queries: cutoff, windows, source fixes (SRC-1..3, TK-1,
AG-1, PF-1..6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog.registry import query, table
from sluice.operators import batch as B
from sluice.operators import late as LT

ORDERS_START = "1996-01-01 00:00:00"
ORDERS_CAP = 1003
EVENTS_START = "2024-01-10 12:00:00"
EVENTS_CAP = 2500

_ORDERS_CUT = f"""(SELECT max(o_orderdate) FROM (SELECT o_orderdate FROM orders
    WHERE o_orderdate > TIMESTAMP '{ORDERS_START}' ORDER BY o_orderdate LIMIT {ORDERS_CAP}))"""
_EVENTS_CUT = f"""(SELECT max(ts) FROM (SELECT ts FROM events
    WHERE ts > TIMESTAMP '{EVENTS_START}' ORDER BY ts LIMIT {EVENTS_CAP}))"""


def _orders_window(spark, sf, mode="incremental"):
    o = table(spark, sf, "orders")
    return o, B.resolve_window(o, "o_orderdate", ORDERS_START, ORDERS_CAP, mode=mode)


@query("batch_bounds", sql=f"""
    SELECT min(o_orderkey) AS lower_bound, max(o_orderkey) AS upper_bound,
           max(o_orderdate) AS batch_cutoff, count(*) AS batch_rows
    FROM orders
    WHERE o_orderdate > TIMESTAMP '{ORDERS_START}' AND o_orderdate <= {_ORDERS_CUT}""")
def batch_bounds(spark, sf):
    o, w = _orders_window(spark, sf)
    return B.batch_bounds(o, w, "o_orderkey")


@query("incremental_window", sql=f"""
    SELECT * FROM orders
    WHERE o_orderdate > TIMESTAMP '{ORDERS_START}' AND o_orderdate <= {_ORDERS_CUT}""")
def incremental_window(spark, sf):
    o, w = _orders_window(spark, sf)
    return w.apply(o)


@query("backfill_window", sql=f"""
    SELECT * FROM orders
    WHERE o_orderdate >= TIMESTAMP '{ORDERS_START}' AND o_orderdate <= {_ORDERS_CUT}""")
def backfill_window(spark, sf):
    o, w = _orders_window(spark, sf, mode="backfill")
    return w.apply(o)


@query("batch_bounds_events", sql=f"""
    SELECT min(event_id) AS lower_bound, max(event_id) AS upper_bound,
           max(ts) AS batch_cutoff, count(*) AS batch_rows
    FROM events
    WHERE ts > TIMESTAMP '{EVENTS_START}' AND ts <= {_EVENTS_CUT}""")
def batch_bounds_events(spark, sf):
    e = table(spark, sf, "events")
    w = B.resolve_window(e, "ts", EVENTS_START, EVENTS_CAP)
    return B.batch_bounds(e, w, "event_id")


@query("batch_uncapped", sql="""
    SELECT min(event_id) AS lower_bound, max(event_id) AS upper_bound,
           max(ts) AS batch_cutoff, count(*) AS batch_rows
    FROM events""")
def batch_uncapped(spark, sf):
    """No bookmark and a cap above the table size: the whole table."""
    e = table(spark, sf, "events")
    w = B.resolve_window(e, "ts", None, B.REFERENCE_BATCH_CAP)
    return B.batch_bounds(e, w, "event_id")


@query("batch_offset_start", sql=f"""
    SELECT count(*) AS batch_rows, min(ts) AS first_version, max(ts) AS batch_cutoff
    FROM events
    WHERE ts > (SELECT ts FROM events ORDER BY ts LIMIT 1 OFFSET 4999) + INTERVAL 1 MILLISECOND
      AND ts <= (SELECT max(ts) FROM (SELECT ts FROM events
                 WHERE ts > (SELECT ts FROM events ORDER BY ts LIMIT 1 OFFSET 4999) + INTERVAL 1 MILLISECOND
                 ORDER BY ts LIMIT 1000))""")
def batch_offset_start(spark, sf):
    """PF-1 / D3: the reference's bookmark + 1 ms start (offset_ms=1), with the
    bookmark taken as the 5000th version of the table."""
    e = table(spark, sf, "events")
    bookmark_us = B.cap_cutoff(e, "ts", None, 5000)
    w = B.BatchWindow("ts", bookmark_us + 1000, B.cap_cutoff(e, "ts", bookmark_us + 1000, 1000))
    return w.apply(e).agg(F.count(F.lit(1)).alias("batch_rows"), F.min("ts").alias("first_version"),
                          F.max("ts").alias("batch_cutoff"))


@query("next_start", sql="""
    SELECT event_type,
           COALESCE(date_trunc('millisecond', max(ts) + INTERVAL 1 MILLISECOND), TIMESTAMP '1970-01-01') AS next_start
    FROM events GROUP BY event_type
    UNION ALL SELECT 'none' AS event_type, TIMESTAMP '1970-01-01' AS next_start""")
def next_start(spark, sf):
    """PF-1: per-table next start from each bookmark (max version); a missing
    bookmark starts at the epoch."""
    e = table(spark, sf, "events")
    marks = e.groupBy("event_type").agg(F.max("ts").alias("bookmark"))
    none = spark.createDataFrame([("none", None)], "event_type string, bookmark timestamp_ntz")  # a table never extracted
    return marks.unionByName(none).select("event_type", B.next_start("bookmark").alias("next_start"))


# Shifted dates so the floors and the pre-1900 rule have work to do.
_SHIFTED = """o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate - INTERVAL 1200 MONTH
         WHEN o_orderkey % 3 = 1 THEN o_orderdate - INTERVAL 360 MONTH
         ELSE o_orderdate END AS created_at,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL
         WHEN o_orderkey % 5 = 1 THEN o_orderdate - INTERVAL 96 MONTH
         ELSE o_orderdate END AS updated_at,
    CASE WHEN o_orderkey % 4 = 0 THEN true WHEN o_orderkey % 4 = 1 THEN NULL ELSE false END AS deleted"""


def _shifted(spark, sf):
    return table(spark, sf, "orders").selectExpr(*[c.strip() for c in _split(_SHIFTED)])


def _split(sel: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in sel:
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
            continue
        depth += ch == "("
        depth -= ch == ")"
        cur += ch
    return out + [cur]


@query("pre1900_null", sql=f"""
    SELECT o_orderkey, CASE WHEN created_at < DATE '1900-01-01' THEN NULL ELSE created_at END AS created_at
    FROM (SELECT {_SHIFTED} FROM orders)""")
def pre1900_null(spark, sf):
    d = _shifted(spark, sf)
    return d.select("o_orderkey", B.null_before("created_at").alias("created_at"))


@query("ts_floor", sql=f"""
    SELECT o_orderkey,
      CASE WHEN created_at < TIMESTAMP '2000-01-01' THEN TIMESTAMP '2000-01-01' ELSE created_at END AS created_at,
      CASE WHEN updated_at < TIMESTAMP '2000-01-01' THEN TIMESTAMP '2000-01-01' ELSE updated_at END AS updated_at
    FROM (SELECT {_SHIFTED} FROM orders)""")
def ts_floor(spark, sf):
    d = _shifted(spark, sf)
    return B.source_fixes(d).select("o_orderkey", "created_at", "updated_at")


@query("soft_delete", sql=f"""
    SELECT o_orderkey, o_orderstatus FROM (SELECT {_SHIFTED} FROM orders) WHERE deleted = false""")
def soft_delete(spark, sf):
    d = _shifted(spark, sf)
    return B.source_fixes(d, floor_cols=(), filter_deleted=True).select("o_orderkey", "o_orderstatus")


@query("source_fixes", sql=f"""
    SELECT o_orderkey,
      CASE WHEN c < TIMESTAMP '2000-01-01' THEN TIMESTAMP '2000-01-01' ELSE c END AS created_at,
      CASE WHEN updated_at < TIMESTAMP '2000-01-01' THEN TIMESTAMP '2000-01-01' ELSE updated_at END AS updated_at
    FROM (SELECT *, CASE WHEN created_at < DATE '1900-01-01' THEN NULL ELSE created_at END AS c
          FROM (SELECT {_SHIFTED} FROM orders))
    WHERE deleted = false""")
def source_fixes(spark, sf):
    """PF-4, PF-5 and PF-6 together, in the reference's order."""
    d = _shifted(spark, sf)
    fixed = B.source_fixes(d, null_before_cols=("created_at",), filter_deleted=True)
    return fixed.select("o_orderkey", "created_at", "updated_at")


@query("audit_columns", sql="""
    SELECT o_orderkey, true AS same_day, true AS of_this_run FROM orders""")
def audit_columns(spark, sf):
    """PF-3: every row has the time of this run and that time's date."""
    before = spark.sql("SELECT current_timestamp()").first()[0]
    a = B.add_audit_columns(table(spark, sf, "orders"))
    return a.select("o_orderkey", (F.to_date("extracted_at") == F.col("extract_date")).alias("same_day"),
                    F.col("extracted_at").between(F.lit(before), F.current_timestamp()).alias("of_this_run"))


@query("batch_gate", sql="""
    SELECT CAST(ts AS DATE) AS batch_day, count(*) AS batch_rows, count(*) >= 350 AS load_batch,
           count(*) < 350 AS clear_backfill
    FROM events GROUP BY 1""")
def batch_gate(spark, sf):
    """PF-2 + ST-9: per daily batch, the minimum-size gate (threshold 350 so
    some days fail at every scale) and whether the batch ends the backfill."""
    from sluice.operators import state as S

    e = table(spark, sf, "events")
    days = e.groupBy(F.to_date("ts").alias("batch_day")).agg(F.count(F.lit(1)).alias("batch_rows"))
    named = days.select(F.lit("events").alias("schema"), F.col("batch_day").cast("string").alias("table_name"), "batch_rows")
    ended = S.completion_updates(named, 350).select(F.col("table_name").cast("date").alias("batch_day"), "remove_backfill")
    return days.join(ended, "batch_day", "left").select(
        "batch_day", "batch_rows", B.gate(F.col("batch_rows"), 350).alias("load_batch"),
        F.coalesce("remove_backfill", F.lit(False)).alias("clear_backfill"))


def _drained(table_name: str, version: str, cap: int) -> str:
    """The windows one after the other, each from the end of the last."""
    return f"""
    WITH RECURSIVE p AS (SELECT {version} AS v, sum(count(*)) OVER (ORDER BY {version}) AS upto FROM {table_name} GROUP BY 1),
    t AS (SELECT max(upto) AS total FROM p),
    w(before, upto) AS (
        SELECT CAST(0 AS HUGEINT), (SELECT min(upto) FROM p, t WHERE upto >= least({cap}, total))
        UNION ALL
        SELECT w.upto, (SELECT min(p.upto) FROM p, t WHERE p.upto >= least(w.upto + {cap}, total))
        FROM w, t WHERE w.upto < t.total)
    SELECT '{table_name}' AS table_name, p.v AS cutoff, CAST(w.upto - w.before AS BIGINT) AS rows_read
    FROM w JOIN p ON p.upto = w.upto"""


@query("drain_cutoffs", sql=f"{_drained('orders', 'o_orderdate', 501)} UNION ALL SELECT * FROM ({_drained('events', 'ts', 333)})")
def drain_cutoffs(spark, sf):
    """SRC-1 / TK-1: every window of a drain of two tables, daily versions
    with many ties and versions to the microsecond, from one scan of each."""
    from sluice.operators.cutoffs import all_cutoffs

    out = []
    for name, version, cap in (("orders", "o_orderdate", 501), ("events", "ts", 333)):
        df = table(spark, sf, name)
        windows = all_cutoffs(df, B.micros_of(df, version), cap, ranges=24, fan=4)
        cutoff = F.expr("timestampadd(MICROSECOND, cutoff_us, TIMESTAMP_NTZ '1970-01-01 00:00:00')")
        out.append(windows.select(F.lit(name).alias("table_name"), cutoff.alias("cutoff"), F.col("rows").alias("rows_read")))
    return out[0].unionByName(out[1])


_BOOKMARK = "2024-01-20 12:00:00"
_LATE = "event_id % 53 = 0 AND day(ts) IN (3, 4, 17, 25)"


def _read_before(spark, sf):
    """Key and version of the events that were there when the batches up to the bookmark ran."""
    e = table(spark, sf, "events")
    return e.where(F.expr(f"NOT ({_LATE}) AND ts <= TIMESTAMP_NTZ '{_BOOKMARK}'")).select("event_id", "ts")


@query("late_rows", sql=f"SELECT * FROM events WHERE {_LATE} AND ts <= TIMESTAMP '{_BOOKMARK}'")
def late_rows(spark, sf):
    """SRC-2 / ST-8: events that came after the batches with versions at or
    below the bookmark: found by checksums per day, read again by day."""
    return LT.late_rows(table(spark, sf, "events"), _read_before(spark, sf), _BOOKMARK, "event_id", "ts")


@query("late_buckets", sql=f"""
    SELECT date_trunc('day', ts)::TIMESTAMP AS bucket, count(*) AS source_rows, count(*) FILTER (WHERE NOT ({_LATE})) AS read_rows
    FROM events WHERE ts <= TIMESTAMP '{_BOOKMARK}' GROUP BY 1 HAVING count(*) FILTER (WHERE {_LATE}) > 0""")
def late_buckets(spark, sf):
    """The days whose source rows are not those that were read."""
    return LT.differing_buckets(table(spark, sf, "events"), _read_before(spark, sf), _BOOKMARK, "event_id", "ts")
