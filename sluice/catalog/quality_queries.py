"""Quality, reconciliation, invoice-repair and lifecycle queries (QA-1..3,
AG-2, AG-3, DX-1..8, end-to-end batch run)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog.registry import ORACLES, query, table
from sluice.functions import repairs as RP
from sluice.operators import batch as B
from sluice.operators import quality as Q
from sluice.operators import runlog as R
from sluice.operators import state as S
from sluice.plans.run import read_committed, run_batch
from sluice.plans.spec import TableSpec
from sluice.session import shared_dir
from sluice.sources import curated as K
from sluice.sources import warehouse as W

_AMT = "CAST(l_extendedprice AS DECIMAL(18,2))"


@query("reconcile", sql=f"""
    WITH t AS (SELECT l_orderkey AS key, CAST(sum({_AMT}) AS DECIMAL(28,2)) AS items_total, count(*) AS item_rows
               FROM lineitem GROUP BY 1),
    h AS (SELECT o_orderkey AS key, CAST(o_totalprice AS DECIMAL(18,2)) AS header_total FROM orders)
    SELECT COALESCE(h.key, t.key) AS key, h.header_total, t.items_total, COALESCE(t.item_rows, 0) AS item_rows,
           CAST(h.header_total - t.items_total AS DECIMAL(29,2)) AS difference,
           CASE WHEN t.item_rows IS NULL THEN 'missing_items' WHEN h.header_total IS NULL THEN 'orphan_items'
                WHEN abs(h.header_total - t.items_total) <= 0.1 THEN 'match' ELSE 'mismatch' END AS status
    FROM h FULL JOIN t ON h.key = t.key""")
def reconcile(spark, sf):
    """DX-8: invoice (orders) totals vs the sum of their items (lineitem).
    Spark sums decimal(18,2) as decimal(28,2); the oracle states that type."""
    return Q.reconcile(table(spark, sf, "lineitem"), table(spark, sf, "orders"), "l_orderkey", "o_orderkey",
                       F.col("l_extendedprice").cast("decimal(18,2)"), F.col("o_totalprice").cast("decimal(18,2)"))


@query("reconcile_summary", sql=f"""
    WITH t AS (SELECT l_orderkey AS key, sum({_AMT}) AS items_total FROM lineitem GROUP BY 1),
    h AS (SELECT o_orderkey AS key, CAST(o_totalprice AS DECIMAL(18,2)) AS header_total FROM orders)
    SELECT CASE WHEN t.key IS NULL THEN 'missing_items' WHEN h.key IS NULL THEN 'orphan_items'
                WHEN abs(h.header_total - t.items_total) <= 0.1 THEN 'match' ELSE 'mismatch' END AS status,
           count(*) AS invoices
    FROM h FULL JOIN t ON h.key = t.key GROUP BY 1""")
def reconcile_summary(spark, sf):
    """DX-8 rolled up: invoices per reconciliation status."""
    r = reconcile(spark, sf)
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("invoices"))


@query("orphans", sql="""
    SELECT l.l_orderkey, count(*) AS orphan_items FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT CASE WHEN o_orderkey % 6 = 0 THEN -o_orderkey ELSE o_orderkey END AS k FROM orders) o
                      WHERE o.k = l.l_orderkey)
    GROUP BY 1""")
def orphans(spark, sf):
    """Items whose invoice is missing; the keys of every sixth invoice are moved."""
    moved = F.expr("CASE WHEN o_orderkey % 6 = 0 THEN -o_orderkey ELSE o_orderkey END")
    heads = table(spark, sf, "orders").withColumn("o_orderkey", moved)
    return Q.orphans(table(spark, sf, "lineitem"), heads, "l_orderkey", "o_orderkey").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("orphan_items"))


# Invoice-item columns derived from lineitem (same SQL text in both engines).
ITEM_COLS = [
    ("l_orderkey", "l_orderkey"),
    ("line_gross_amount", "l_extendedprice"),
    ("line_discount_1", "CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice ELSE l_discount * 100 END"),
    ("line_discount_amount_1", "l_extendedprice"),
    ("line_discount_2", "l_tax * 100"),
    ("line_discount_amount_2", "l_extendedprice * l_tax"),
    ("line_discount_amount_3", "l_extendedprice * l_discount / 3"),
    ("line_discount_amount_4", "l_extendedprice * l_discount / 4"),
    ("line_discount_amount_5", "l_extendedprice * l_discount / 5"),
    ("qty_sold_raw", "CASE WHEN l_linenumber % 4 = 0 THEN 0 ELSE l_quantity END"),
    ("qty_sold", "l_quantity"),
    ("qty_order", "CASE WHEN l_linenumber = 1 THEN 0 ELSE l_quantity END"),
    ("selling_price", "l_extendedprice * l_linenumber"),
    ("selling_price_raw", "CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE l_extendedprice / l_quantity END"),
    ("conversion_1_to_4", "l_quantity"),
    ("line_net_amount", "l_extendedprice * (1 - l_discount)"),
    ("tax_amount_1", "l_extendedprice * l_tax"),
    ("tax_amount_2", "l_extendedprice * l_tax / 2"),
    ("tax_amount_3", "l_extendedprice * l_tax / 3"),
]
ITEMS = "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in ITEM_COLS) + " FROM lineitem)"
AMOUNTS = [f"line_discount_amount_{i}" for i in range(1, 6)]


def items(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in ITEM_COLS])


def _fix_sql(d, a):
    return (f"CASE WHEN {d} > 80 AND round({d}, 2) = round({a}, 2) "
            f"THEN round(100 * {d} / NULLIF(qty_sold * selling_price / NULLIF(conversion_1_to_4, 0), 0), 2) "
            f"ELSE round({d}, 2) END")


@query("discount_fix", sql=f"""
    SELECT l_orderkey, {_fix_sql('line_discount_1', 'line_discount_amount_1')} AS line_discount_1,
           {_fix_sql('line_discount_2', 'line_discount_amount_2')} AS line_discount_2 FROM {ITEMS}""")
def discount_fix(spark, sf):
    """DX-2: discount percents that are really amounts are recomputed."""
    it = items(spark, sf)
    return it.select("l_orderkey", *[
        RP.discount_percent_fix(f"line_discount_{i}", f"line_discount_amount_{i}", "qty_sold", "selling_price",
                                "conversion_1_to_4").alias(f"line_discount_{i}") for i in (1, 2)])


_SUM5 = " + ".join(AMOUNTS)


@query("discount_base", sql=f"SELECT l_orderkey, line_gross_amount - ({_SUM5}) AS line_discount_based FROM {ITEMS}")
def discount_base(spark, sf):
    """DX-3: gross minus the five discount amounts."""
    return items(spark, sf).select("l_orderkey", RP.discount_base("line_gross_amount", AMOUNTS).alias("line_discount_based"))


@query("conversion", sql=f"""
    SELECT l_orderkey, CASE WHEN qty_order <> 0 THEN selling_price / NULLIF(
        (({_SUM5}) + (line_gross_amount - ({_SUM5}))) / NULLIF(qty_order, 0), 0) END AS true_conversion
    FROM {ITEMS}""")
def conversion(spark, sf):
    """DX-4: the implied unit conversion (NULL when qty_order is 0)."""
    it = items(spark, sf).withColumn("line_discount_based", RP.discount_base("line_gross_amount", AMOUNTS))
    return it.select("l_orderkey", RP.true_conversion("selling_price", AMOUNTS, "line_discount_based",
                                                      "qty_order").alias("true_conversion"))


@query("tax_net", sql=f"""
    SELECT l_orderkey, line_net_amount + (tax_amount_1 + tax_amount_2 + tax_amount_3) AS line_net_amount FROM {ITEMS}""")
def tax_net(spark, sf):
    """DX-5: net amount including the three taxes."""
    return items(spark, sf).select("l_orderkey", RP.net_with_tax("line_net_amount", ["tax_amount_1", "tax_amount_2",
                                                                                     "tax_amount_3"]).alias("line_net_amount"))


def _impute_sql(t, g, n, d):
    return (f"CASE WHEN ({t} = 0 OR {t} IS NULL) AND {g} IS NOT NULL AND {g} <> 0 AND {d} IS NOT NULL AND {d} <> 0 "
            f"THEN {g} * {n} / {d} ELSE {t} END")


@query("impute_price", sql=f"""
    SELECT l_orderkey, {_impute_sql('selling_price_raw', 'line_gross_amount', 'conversion_1_to_4', 'qty_order')} AS selling_price
    FROM {ITEMS}""")
def impute_price(spark, sf):
    """DX-6: a zero or missing selling price from gross * conversion / qty."""
    return items(spark, sf).select("l_orderkey", RP.impute_when_missing(
        "selling_price_raw", "line_gross_amount", "conversion_1_to_4", "qty_order").alias("selling_price"))


@query("impute_qty", sql=f"""
    SELECT l_orderkey, {_impute_sql('qty_sold_raw', 'line_gross_amount', 'conversion_1_to_4', 'selling_price_raw')} AS qty_sold
    FROM {ITEMS}""")
def impute_qty(spark, sf):
    """DX-7: a zero or missing sold quantity from gross * conversion / price."""
    return items(spark, sf).select("l_orderkey", RP.impute_when_missing(
        "qty_sold_raw", "line_gross_amount", "conversion_1_to_4", "selling_price_raw").alias("qty_sold"))


# ---- end-to-end batch runs -------------------------------------------------

_SOURCE_COLS = [
    "o_orderkey AS id", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
    "o_orderdate + INTERVAL 10 YEAR AS created_at",
    "o_orderdate + INTERVAL 10 YEAR + INTERVAL 1 HOUR * CAST(o_orderkey % 5 AS INTEGER) AS updated_at",
    "o_orderkey % 10 = 0 AS deleted",
]
_UPDATE_COLS = [
    "o_orderkey AS id", "o_custkey", "'F' AS o_orderstatus", "o_totalprice + 1 AS o_totalprice", "o_orderpriority",
    "o_orderdate + INTERVAL 10 YEAR AS created_at", "o_orderdate + INTERVAL 10 YEAR + INTERVAL 400 DAY AS updated_at",
    "o_orderkey % 10 = 0 AS deleted",
]
RUN_CAP = 5000
#: Runs after which curated versions are dropped that are older than those of the last two states.
EXPIRE_RUNS = 10


def _run_source(spark, sf):
    o = table(spark, sf, "orders")
    base = o.selectExpr(*_SOURCE_COLS)
    updates = o.where(F.col("o_orderstatus") == "O").selectExpr(*_UPDATE_COLS)
    return base.unionByName(updates)


def _spec():
    return TableSpec.from_dict("orders", {
        "ready": {"sales": True},
        "transformation_order": ["join", "rename_columns", "upper", "rounding", "keep_columns"],
        "filter_deleted": True,
        "join": {"with_table": "customer", "how": "left", "left": "o_custkey", "right": "c_custkey",
                 "right_table_columns": ["c_mktsegment"]},
        "rename_columns": {"o_orderpriority": "priority", "customer__c_mktsegment": "segment"},
        "upper": ["priority"],
        "rounding": {"o_totalprice": 1},
        "keep_columns": {"id": "bigint", "o_orderstatus": "string", "o_totalprice": "decimal(10,1)",
                         "priority": "string", "segment": "string", "created_at": "timestamp_ntz",
                         "updated_at": "timestamp_ntz"},
    })


_RUN_SQL_SRC = """
    SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
           o_orderdate + INTERVAL 10 YEAR AS created_at,
           o_orderdate + INTERVAL 10 YEAR + to_hours(CAST(o_orderkey % 5 AS INTEGER)) AS updated_at,
           o_orderkey % 10 = 0 AS deleted FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, 'F', o_totalprice + 1, o_orderpriority, o_orderdate + INTERVAL 10 YEAR,
           o_orderdate + INTERVAL 10 YEAR + INTERVAL 400 DAY, o_orderkey % 10 = 0 FROM orders WHERE o_orderstatus = 'O'"""


@query("batch_runs", sql=f"""
    WITH src AS ({_RUN_SQL_SRC}),
    latest AS (SELECT * FROM src WHERE deleted = false AND created_at IS NOT NULL AND updated_at IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)
    SELECT l.id, l.o_orderstatus, TRY_CAST(round(CAST(l.o_totalprice AS DECIMAL(38,10)), 1) AS DECIMAL(10,1)) AS o_totalprice,
           upper(trim(l.o_orderpriority)) AS priority, c.c_mktsegment AS segment, l.created_at, l.updated_at
    FROM latest l LEFT JOIN customer c ON l.o_custkey = c.c_custkey""")
def batch_runs(spark, sf):
    """Whole lifecycle: capped batches (5000 rows) until the source is
    drained; each run cleans, enriches, merges into the key buckets of the
    curated table and persists the advanced bookmark, which names the curated
    version.  Returns the curated table as the state names it.

    The source is stored in order of its versions and the windows of all runs
    are found in one scan, so that a run reads its own rows and no others."""
    source = B.by_version(_run_source(spark, sf), "updated_at")
    windows = B.known_windows(source, "updated_at", RUN_CAP)
    curated_root, state_root = shared_dir(spark, "curated-runs"), shared_dir(spark, "state-runs")
    spec, tables, state = _spec(), {}, S.with_curated(S.empty_state(spark))
    W.write_version(state, state_root, 0)

    def resolver(name, from_warehouse):
        if name not in tables:
            tables[name] = table(spark, sf, name)
        return tables[name]

    run, reached = 0, None
    while True:
        run += 1
        state = W.read_version(spark, state_root, run - 1, state.schema)
        res = run_batch(spark, spec, "sales", source, state, curated_root, cap=RUN_CAP, resolver=resolver, windows=windows)
        W.write_version(res.state, state_root, run)
        if res.drained:
            break
        if run % EXPIRE_RUNS == 0 and res.curated_version:
            K.expire(spark, curated_root, keep=res.curated_version - 1)
        if reached is not None and res.window.cutoff_us <= reached:
            raise RuntimeError(f"batch {run} made no progress beyond {reached}")
        reached = res.window.cutoff_us
    return read_committed(spark, curated_root, W.read_version(spark, state_root, run), "sales", "orders")


ORACLES_BATCH_RUNS = ORACLES["batch_runs"]


@query("batch_run_full", sql=ORACLES_BATCH_RUNS)
def batch_run_full(spark, sf):
    """One run with the reference's 10 M cap (the whole source in one batch
    at these sizes); equals ``batch_runs``."""
    source = _run_source(spark, sf)
    curated_root = shared_dir(spark, "curated-full")
    res = run_batch(spark, _spec(), "sales", source, S.empty_state(spark), curated_root,
                    resolver=lambda name, wh: table(spark, sf, name))
    assert res.loaded
    return read_committed(spark, curated_root, res.state, "sales", "orders")


@query("run_log", sql=f"""
    WITH src AS ({_RUN_SQL_SRC}),
    cut AS (SELECT max(updated_at) AS c FROM (SELECT updated_at FROM src ORDER BY updated_at LIMIT {RUN_CAP})),
    n AS (SELECT count(*) FILTER (WHERE updated_at <= c) AS first, count(*) FILTER (WHERE updated_at > c) AS rest,
                 count(DISTINCT id) FILTER (WHERE updated_at <= c AND NOT deleted) AS kept FROM src, cut)
    SELECT 'run-1' AS run_id, 'SUCCESS' AS status, first AS extracted, kept AS cleaned, CAST(1 AS BIGINT) AS curated_version,
           false AS has_error, true AS timed FROM n
    UNION ALL SELECT 'run-2', 'FAILED', NULL, NULL, NULL, true, true
    UNION ALL SELECT 'run-3', 'SKIPPED', rest, 0, 1, false, true FROM n
    UNION ALL SELECT 'run-4', 'IDLE', 0, NULL, 1, false, true""")
def run_log(spark, sf):
    """QA-1 / QA-2: the records of four runs over the whole source: a capped
    batch that loads, one whose source breaks midway, the same rest with every
    row deleted (cleaned to nothing: skipped, the curated version stays), and
    one that finds no window."""
    source = _run_source(spark, sf)
    curated, state_root, log = shared_dir(spark, "curated-log"), shared_dir(spark, "state-log"), shared_dir(spark, "run-log")
    broken = source.withColumn("o_totalprice", F.when(F.col("id") % 2 == 1, F.raise_error(F.lit("broken row")).cast("double"))
                               .otherwise(F.col("o_totalprice")))
    gone = source.withColumn("deleted", F.lit(True))
    W.write_version(S.empty_state(spark), state_root, 0)
    version = 0
    for n, (rows, cap) in enumerate([(source, RUN_CAP), (broken, 10**12), (gone, 10**12), (gone, 10**12)], start=1):
        state = W.read_version(spark, state_root, version)
        try:
            res = run_batch(spark, _spec(), "sales", rows, state, curated, cap=cap, log_root=log, run_id=f"run-{n}",
                            resolver=lambda name, wh: table(spark, sf, name))
        except Exception as e:  # noqa: BLE001 - the run that is meant to fail; its record tells the error
            if n != 2 or "broken row" not in str(e):
                raise
            continue
        version += 1
        W.write_version(res.state, state_root, version)
    return R.read(spark, log).select("run_id", "status", "extracted", "cleaned", "curated_version",
                                     F.coalesce(F.contains("error", F.lit("broken row")), F.lit(False)).alias("has_error"),
                                     (F.col("duration_s") > 0).alias("timed"))


@query("landing_extract_transform", sql=ORACLES_BATCH_RUNS)
@query("landing_extract_transform_full", sql=ORACLES_BATCH_RUNS)
def landing_extract_transform_full(spark, sf, cap=B.REFERENCE_BATCH_CAP):
    """E2 + E3 with DX-10 over the whole source: every capped window is
    extracted to landing, partitioned by the registry's ``partition_by``
    (order status), read back and transformed (dedup, join, rules, declared
    schema) until the source is drained; the latest version of a key that
    several batches hold is kept."""
    from sluice.operators.merge import latest_per_key
    from sluice.plans.run import extract_batch, transform_batch

    spec = _spec()
    spec.partition_by = "o_orderstatus"
    source = _run_source(spark, sf)
    landing, out, n = shared_dir(spark, "landing-orders"), shared_dir(spark, "landed-transformed"), 0
    for n, window in enumerate(B.drain_windows(source, "updated_at", cap), start=1):
        extract_batch(source, spec, window, landing, batch_id=n)
        batch = transform_batch(spark, spec, landing, n, resolver=lambda name, wh: table(spark, sf, name))
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
    if n == 0:
        extract_batch(source, spec, B.BatchWindow("updated_at", None, None), landing, batch_id=0)
        return transform_batch(spark, spec, landing, 0, resolver=lambda name, wh: table(spark, sf, name))
    rows = spark.read.parquet(*[f"{out}/batch={i}" for i in range(1, n + 1)])
    return latest_per_key(rows, key="id", version="updated_at") if n > 1 else rows


@query("run_audit", sql=f"""
    WITH src AS ({_RUN_SQL_SRC}),
    b AS (SELECT *, CASE WHEN updated_at <= (SELECT max(updated_at) FROM (SELECT updated_at FROM src ORDER BY updated_at LIMIT {RUN_CAP}))
                      THEN 1 ELSE 2 END AS batch_no FROM src)
    SELECT 'sales' AS schema, 'orders' AS table_name, batch_no, count(*) AS extracted,
           count(*) FILTER (WHERE deleted = false) AS cleaned, count(*) FILTER (WHERE deleted = false) AS loaded,
           'SUCCESS' AS status
    FROM b GROUP BY batch_no""")
def run_audit(spark, sf):
    """QA-1 / QA-2: per-stage counts of two batches (the first capped batch
    and the rest), gathered with observe on the write, as audit records."""
    from sluice.operators import batch as B
    from sluice.plans.run import require_timestamps

    source = _run_source(spark, sf)
    rows = []
    first = B.resolve_window(source, "updated_at", None, RUN_CAP)
    windows = [first, B.BatchWindow("updated_at", first.cutoff_us, B.cap_cutoff(source, "updated_at", first.cutoff_us,
                                                                                 10**12))]
    for no, w in enumerate(windows, start=1):
        batch, ext = Q.observe_rows(w.apply(source), f"extracted{no}")
        clean = require_timestamps(B.source_fixes(batch, filter_deleted=True))
        clean, cln = Q.observe_rows(clean, f"cleaned{no}")
        out = shared_dir(spark, f"audit-{no}")
        clean.write.mode("overwrite").parquet(out)
        loaded = spark.read.parquet(out)
        rows.append(loaded.agg(F.count(F.lit(1)).alias("loaded")).select(
            F.lit("sales").alias("schema"), F.lit("orders").alias("table_name"), F.lit(no).alias("batch_no"),
            F.lit(ext.get["rows"]).cast("bigint").alias("extracted"), F.lit(cln.get["rows"]).cast("bigint").alias("cleaned"),
            F.col("loaded")))
    return Q.run_record(rows[0].unionByName(rows[1]))
