"""The flagship and the landing path over every row, in one batch and in many."""

import pytest

from sluice.catalog import flagship as FL
from sluice.catalog import quality_queries as QQ
from conftest import SF_SMALL


def rows(df):
    return sorted(map(str, df.collect()))


def test_entry_reads_every_order(spark):
    from __spark_entry__ import entry

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    want = {r[0] for r in orders.where("o_orderdate IS NOT NULL").select("o_orderkey").collect()}
    got = [r.o_orderkey for r in entry(spark).collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("full", [FL.flagship_full, QQ.landing_extract_transform_full])
def test_many_batches_equal_one(spark, full):
    assert rows(full(spark, SF_SMALL, cap=700)) == rows(full(spark, SF_SMALL))
