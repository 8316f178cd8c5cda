"""Bounded batches: the distributed cutoff equals the brute-force
ORDER BY ... LIMIT answer; windows, ties, modes and pushdown."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, plan_text
from sluice.operators import batch as B


def brute_cutoff(df, col, start, cap):
    rows = [r[0] for r in df.where(F.col(col) > F.lit(start).cast("timestamp_ntz")).orderBy(col).select(col).limit(cap).collect()]
    return max(rows) if rows else None


def us_to_dt(us):
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)


@pytest.mark.parametrize("table,col,start", [("events", "ts", "2024-01-05 00:00:00"), ("orders", "o_orderdate", "1996-01-01 00:00:00")])
@pytest.mark.parametrize("cap", [1, 7, 1003, 2500, 10**7])
def test_cutoff_matches_brute_force(spark, table, col, start, cap):
    df = spark.read.parquet(f"{SF_MID}/{table}.parquet")
    w = B.resolve_window(df, col, start, cap)
    expect = brute_cutoff(df, col, start, cap)
    assert us_to_dt(w.cutoff_us) == expect
    assert w.rows == w.apply(df).count()


def test_small_fanout_deep_refinement(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for cap in (1, 3, 50, 333):
        w = B.resolve_window(df, "ts", "2024-01-02 00:00:00", cap, fanout=2)
        assert us_to_dt(w.cutoff_us) == brute_cutoff(df, "ts", "2024-01-02 00:00:00", cap)


def test_ties_included_and_backfill(spark):
    df = spark.read.parquet(f"{SF_MID}/orders.parquet")
    w = B.resolve_window(df, "o_orderdate", "1996-01-01", 1003)
    assert w.apply(df).count() == 1009  # FIXTURES: cap 1003 splits a tied day
    b = B.resolve_window(df, "o_orderdate", "1996-01-01", 1003, mode="backfill")
    at_start = df.where(F.col("o_orderdate") == F.lit("1996-01-01").cast("timestamp_ntz")).count()
    assert b.apply(df).count() == 1009 + at_start == b.rows


def test_empty_and_consecutive_batches(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert B.resolve_window(df, "ts", "2030-01-01", 10).empty
    # consecutive capped batches partition the table exactly
    start, seen, total = None, 0, df.count()
    for _ in range(100):
        w = B.resolve_window(df, "ts", None if start is None else us_to_dt(start), 3000)
        if w.empty:
            break
        seen += w.apply(df).count()
        start = w.cutoff_us
    assert seen == total


def test_window_filter_pushed_to_scan(spark):
    df = spark.read.parquet(f"{SF_MID}/orders.parquet")
    w = B.resolve_window(df, "o_orderdate", "1996-01-01", 1003)
    plan = plan_text(w.apply(df).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    assert "LessThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_floor_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (dt.datetime(1999, 5, 1),), (dt.datetime(2001, 1, 1),)], "u timestamp_ntz")
    out = [r[0] for r in df.select(B.floor_version("u")).collect()]
    assert out == [None, dt.datetime(2000, 1, 1), dt.datetime(2001, 1, 1)]


def test_next_start(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 123456),), (None,)], "b timestamp_ntz")
    out = [r[0] for r in df.select(B.next_start("b")).collect()]
    assert out == [dt.datetime(2024, 1, 1, 0, 0, 0, 124000), dt.datetime(1970, 1, 1)]


def test_date_version_column(spark):
    """A DATE version column: the cutoff and window match ORDER BY ... LIMIT
    (ties on a day all included), and the window filter keeps the date type."""
    o = spark.read.parquet(f"{SF_MID}/orders.parquet").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    start = dt.date(1996, 1, 1)
    for cap in (1, 1003, 5000):
        w = B.resolve_window(o, "d", start, cap)
        days = [r[0] for r in o.where(F.col("d") > F.lit(start)).orderBy("d").select("d").limit(cap).collect()]
        assert us_to_dt(w.cutoff_us).date() == max(days)
        assert w.rows == w.apply(o).count() == o.where((F.col("d") > F.lit(start)) & (F.col("d") <= F.lit(max(days)))).count()
        assert dict(w.apply(o).dtypes)["d"] == "date"
