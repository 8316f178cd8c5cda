"""Smaller public helpers: backfill completion (ST-9) and watermark (ST-8) updates, the reliable
lineage cut, key clustering, and the cutoff on a session-zone timestamp."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, plan_text
from sluice.operators import batch as B
from sluice.operators import merge as M
from sluice.operators import state as S
from sluice.sources import warehouse as W


def test_completion_updates_clear_backfill_only_for_small_batches(spark):
    pairs = spark.createDataFrame([("s", "a"), ("s", "b")], "schema string, table_name string")
    state = S.seed_state(S.empty_state(spark), pairs)
    rows = spark.createDataFrame([("s", "a", 3), ("s", "b", 500)], "schema string, table_name string, batch_rows bigint")
    out = {r["table_name"]: (r["backfill"], r["last_extracted_time"])
           for r in S.update_state(state, S.completion_updates(rows, 100)).collect()}
    assert out == {"a": (False, None), "b": (True, None)}


def test_watermark_updates_move_bookmark_only_when_batch_has_a_max(spark):
    pairs = spark.createDataFrame([("s", "a"), ("s", "b")], "schema string, table_name string")
    state = S.seed_state(S.empty_state(spark), pairs)
    maxima = spark.createDataFrame([("s", "a", dt.datetime(2024, 3, 1, 12)), ("s", "b", None)],
                                   "schema string, table_name string, max_version timestamp_ntz")
    loaded = "2024-03-02 00:00:00"
    out = {r["table_name"]: (r["last_extracted_time"], r["last_successful_load_time"])
           for r in S.update_state(state, S.watermark_updates(maxima, loaded)).collect()}
    assert out == {"a": (dt.datetime(2024, 3, 1, 12), dt.datetime(2024, 3, 2)), "b": (None, dt.datetime(2024, 3, 2))}


def test_lineage_cut_is_a_reliable_checkpoint(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    deep = e
    for i in range(5):
        deep = deep.withColumn("value", F.col("value") + F.lit(i))
    cut = W.with_lineage_cut(spark, deep)
    plan = plan_text(cut)
    assert "Scan parquet" not in plan and "ExistingRDD" in plan  # reads the checkpoint, not the source
    assert sorted(cut.collect()) == sorted(deep.collect())


def test_cluster_by_key_ranges_and_sorts(spark):
    o = spark.read.parquet(f"{SF_MID}/orders.parquet")
    out = M.cluster_by_key(o, "o_orderkey", num_partitions=4)
    bounds = out.rdd.mapPartitions(lambda it: [[r["o_orderkey"] for r in it]]).collect()
    assert sum(len(b) for b in bounds) == o.count()
    assert all(b == sorted(b) for b in bounds)
    nonempty = [b for b in bounds if b]
    assert all(x[-1] < y[0] for x, y in zip(nonempty, nonempty[1:]))  # disjoint, ordered key ranges


def test_cutoff_on_session_zone_timestamp(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(F.col("ts").cast("timestamp").alias("t"))
    start = dt.datetime(2024, 1, 5)
    w = B.resolve_window(e, "t", start, 100)
    after = sorted(r[0] for r in e.where(F.col("t") > F.lit(start)).collect())
    assert dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=w.cutoff_us) == after[99]
    assert w.rows == w.apply(e).count() == sum(1 for v in after if v <= after[99])
