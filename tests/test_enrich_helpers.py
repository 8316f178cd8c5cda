"""Post-join filter (PF-10), column replacement (DX-9), keep columns (PF-8),
max version (AG-3) and distinct rows (AG-4) against plain-Python versions."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.operators import joins as J
from sluice.operators import merge as M
from sluice.operators import quality as Q

KEYS = st.sampled_from([None, 1, 2, 3, 4])
VALS = st.sampled_from([None, "a", "b", "c"])


def brute_enrich(left, right, how, filter_rows, replace):
    """left rows (k, x, y); right rows (k, x, z); output (k, x, y, r__z)."""
    out = []
    for lk, lx, ly in left:
        hits = [r for r in right if lk is not None and r[0] == lk]
        if filter_rows:
            hits = [r for r in hits if lx is not None and r[1] == lx]
        if not hits:
            if how == "left" and not filter_rows:
                out.append((lk, lx, ly, None))
            continue
        for rk, rx, rz in hits:
            x = rx if replace and rx is not None else lx
            out.append((lk, x, ly, rz))
    return sorted(out, key=repr)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(KEYS, VALS, VALS), max_size=25), st.lists(st.tuples(KEYS, VALS, VALS), max_size=12),
       st.sampled_from(["left", "inner"]), st.booleans(), st.booleans())
def test_enrich_filter_and_replace(spark, left, right, how, filt, replace):
    ldf = spark.createDataFrame(left, "k int, x string, y string")
    rdf = spark.createDataFrame(right, "k int, x string, z string")
    out = J.enrich(ldf, rdf, "r", "k", "k", how=how, right_columns=["z"],
                   filter_rows={"x": "x"} if filt else None, replace_columns={"x": "x"} if replace else None)
    assert out.columns == ["k", "x", "y", "r__z"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == brute_enrich(left, right, how, filt, replace)


def test_select_keep_order(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "a int, b string, c double")
    assert M.select_keep(df, ["c", "a"]).columns == ["c", "a"]
    assert M.select_keep(df, {"b": "string", "c": "double"}).columns == ["b", "c"]


def test_max_version_and_distinct(spark):
    ts = dt.datetime
    rows = [(1, ts(2020, 1, 1)), (1, ts(2020, 1, 1)), (2, None), (3, ts(2021, 6, 1)), (2, None)]
    df = spark.createDataFrame(rows, "id int, updated_at timestamp_ntz")
    assert Q.max_version(df).first().max_version == ts(2021, 6, 1)
    assert Q.max_version(df.limit(0)).first().max_version is None
    assert sorted(tuple(r) for r in M.distinct_rows(df).collect()) == sorted(set(rows), key=repr)
