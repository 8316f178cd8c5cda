"""All cutoffs of a drain at once against one window after the other."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from sluice.operators import batch as B
from sluice.operators import cutoffs as C

COUNTS = st.lists(st.sampled_from([1, 1, 1, 1, 2, 3, 9, 40]), min_size=1, max_size=60)


def stepwise(versions, counts, cap):
    out, have = [], 0
    for v, n in zip(versions, counts):
        have += n
        if have >= cap:
            out.append((v, have))
            have = 0
    return out + ([(versions[-1], have)] if have else [])


@settings(max_examples=300, deadline=None)
@given(COUNTS, st.integers(1, 60))
def test_a_range_does_what_its_rows_do(counts, cap):
    steps = C.steps_of(np.array(counts), cap)
    for carry in range(cap):
        assert steps(cap - carry) == C.emitted(np.arange(len(counts)), np.array(counts), carry, cap)[1]


@settings(max_examples=300, deadline=None)
@given(COUNTS, COUNTS, st.integers(1, 60))
def test_functions_compose(left, right, cap):
    both, whole = C.steps_of(np.array(left), cap).then(C.steps_of(np.array(right), cap), cap), C.steps_of(np.array(left + right), cap)
    need = np.arange(1, cap + 1)
    assert (both(need) == whole(need)).all()


def test_rows_without_ties_need_two_segments():
    assert len(C.steps_of(np.ones(100_000, np.int64), 3000).finish) <= 2


@pytest.mark.parametrize("cap,ranges,fan", [(1, 5, 2), (97, 23, 3), (10**6, 7, 16)])
def test_windows_equal_one_after_the_other(spark, cap, ranges, fan):
    for name, column in (("orders", "o_orderdate"), ("events", "ts")):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        us = B.micros_of(df, column)
        rows = sorted((r[0], r[1]) for r in df.groupBy(us.alias("us")).count().where("us is not null").collect())
        got = sorted(map(tuple, C.all_cutoffs(df, us, cap, ranges, fan).collect()))
        assert got == stepwise(*zip(*rows), cap)


def test_drain_windows_equal_repeated_searches(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    got, start = list(B.drain_windows(df, "o_orderdate", 400)), None
    for w in got:
        cutoff, rows = B.cap_cutoff_rows(df, "o_orderdate", start, 400)
        assert (w.start_us, w.cutoff_us, w.rows) == (start, cutoff, rows)
        start = cutoff
    assert B.cap_cutoff_rows(df, "o_orderdate", start, 400) == (None, 0)
    assert list(B.drain_windows(df.limit(0), "o_orderdate", 400)) == []


def test_the_source_is_read_once(spark):
    """Whatever the number of windows, the plan that reads the source runs in one write."""
    acc = spark.sparkContext.accumulator(0)
    df = spark.range(0, 3000, 1, 4).selectExpr("TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS updated_at", "id")

    def seen(batches):
        for b in batches:
            acc.add(len(b))
            yield b

    counted = df.mapInPandas(seen, df.schema)
    assert len(list(B.drain_windows(counted, cap=50))) == 60 and acc.value == 3000
