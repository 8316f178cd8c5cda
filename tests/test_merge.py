"""Latest-version merge: properties, skew and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from sluice.operators import merge as M


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_idempotent_and_order_independent(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a = e.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    b = e.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    once = M.merge_latest(a, b, key="user_id", version="ts")
    twice = M.merge_latest(once, b, key="user_id", version="ts")
    assert rows(once) == rows(twice)
    whole = M.latest_per_key(e, key="user_id", version="ts")
    assert rows(once) == rows(whole)


def test_incoming_wins_equal_version(spark):
    cur = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "old")], "id bigint, updated_at timestamp_ntz, v string")
    new = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "a-new")], "id bigint, updated_at timestamp_ntz, v string")
    assert M.merge_latest(cur, new).collect()[0]["v"] == "a-new"
    older = spark.createDataFrame([(1, dt.datetime(2023, 1, 1), "zzz")], "id bigint, updated_at timestamp_ntz, v string")
    assert M.merge_latest(cur, older).collect()[0]["v"] == "old"


def test_hot_key_is_reduced_map_side(spark):
    """One key holding a third of all rows: the plan pre-aggregates before
    the shuffle (partial aggregate), no window over the key."""
    base = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.expr("timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("updated_at"),
        F.col("id").alias("payload"))
    out = M.latest_per_key(base, key="k", version="updated_at")
    plan = plan_text(out)
    assert "partial_max" in plan and "Window" not in plan
    hot = out.where("k = 0").collect()[0]
    assert hot["payload"] == 29997
    assert out.count() == 20001


def test_null_versions_dropped_before_dedup(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, dt.datetime(2024, 1, 1), "y"), (2, None, "z")],
                               "id bigint, updated_at timestamp_ntz, v string")
    assert rows(M.latest_per_key(df)) == [(1, dt.datetime(2024, 1, 1), "y")]


def test_conform_and_violations(spark):
    df = spark.createDataFrame([("1", "abc", "x")], "a string, b string, c string")
    out = M.conform(df, "a int, b double")
    assert out.dtypes == [("a", "int"), ("b", "double")] and out.collect()[0] == (1, None)
    v = {r["column_name"]: (r["status"], r["failed_casts"]) for r in M.conform_violations(df, "a int, b double, d int").collect()}
    assert v == {"a": ("ok", 0), "b": ("ok", 1), "d": ("missing", None), "c": ("extra", None)}
