"""Late rows, chosen landing batches and the numbering plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from sluice.operators import late as LT
from sluice.operators import numbering as N
from sluice.operators import state as S
from sluice.plans.run import read_committed, run_batch, run_late
from sluice.plans.spec import TableSpec
from sluice.session import shared_dir
from sluice.sources import landing as L


def frame(spark, rows):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, d, h)) for i, d, h in rows], "id long, updated_at timestamp_ntz")


def test_late_rows_by_any_bucket(spark):
    there = [(i, 1 + i % 9, i % 24) for i in range(200)]
    late = [(900, 2, 3), (901, 2, 3), (902, 8, 0), (5, 7, 1), (None, 3, 3)]
    source = frame(spark, there + late + [(903, 9, 23)])
    read = frame(spark, there)
    for bucket in ("hour", "day", "month"):
        got = LT.late_rows(source, read, dt.datetime(2024, 1, 9, 22), bucket=bucket)
        assert sorted(map(str, got.collect())) == sorted(map(str, frame(spark, late).collect()))
    assert LT.late_rows(read, read, dt.datetime(2024, 1, 30)).count() == 0
    # rows that only the read side has make a bucket differ, not a row late
    assert LT.late_rows(read, source, dt.datetime(2024, 1, 30)).count() == 0
    assert LT.differing_buckets(read, source, dt.datetime(2024, 1, 30)).count() == 5


def test_late_rows_reach_the_curated_table(spark):
    spec = TableSpec.from_dict("t", {"transformation_order": []})
    rows = frame(spark, [(i, 5 + i % 3, i) for i in range(9)]).withColumn("created_at", F.col("updated_at"))
    root = shared_dir(spark, "t-late")
    first = run_batch(spark, spec, "s", rows, S.empty_state(spark), root)
    state = spark.createDataFrame(first.state.collect(), first.state.schema)
    late = frame(spark, [(70, 1, 1), (3, 4, 1)]).withColumn("created_at", F.col("updated_at"))
    assert run_batch(spark, spec, "s", rows.unionByName(late), state, root).drained  # the bookmark hides them
    new, counts = run_late(spark, spec, "s", rows.unionByName(late), rows, state, root)
    assert counts["clean"] == 2 and new.first()["last_extracted_time"] == state.first()["last_extracted_time"]
    have = {r.id: r.updated_at.day for r in read_committed(spark, root, new, "s", "t").collect()}
    assert have[70] == 1 and have[3] == 5 and len(have) == 10  # an older version of a key never wins
    assert run_late(spark, spec, "s", rows, rows, spark.createDataFrame(new.collect(), new.schema), root)[1]["clean"] == 0


def test_chosen_batches_prune_folders(spark):
    root = shared_dir(spark, "t-batches")
    for i in range(4):
        L.write_landing(spark.range(10 * i, 10 * i + 3), root, i)
    chosen = L.read_batches(spark, root, spark.createDataFrame([(1,), (3,), (3,), (None,), (77,)], "batch_id int"))
    assert "dynamicpruning" in plan_text(chosen)
    assert sorted(r.id for r in chosen.collect()) == [10, 11, 12, 30, 31, 32]
    files = chosen.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) and all("batch_id=1" in r.f or "batch_id=3" in r.f for r in files)


@pytest.mark.parametrize("number,digits,region,kind,valid", [
    ("+62 812-3456-789", "628123456789", "ID", "mobile", True), ("0812 3456 789", "628123456789", "ID", "mobile", True),
    ("812 3456 789", "628123456789", "ID", "mobile", True), ("62 812 3456 789", "628123456789", "ID", "mobile", True),
    ("0812345", "62812345", "ID", "mobile", False), ("(021) 7654321", "62217654321", "ID", "fixed", True),
    ("(021) 765432", "6221765432", "ID", "fixed", False), ("(0271) 654321", "62271654321", "ID", "fixed", True),
    ("+62 800 1234567", "628001234567", "ID", "toll free", True), ("+65 6123 4567", "6561234567", "SG", "any", True),
    ("0065 1800 1234567", "6518001234567", "SG", "toll free", True), ("+65 1800 123", "651800123", "SG", "toll free", False),
    ("+1 (212) 555-0100", "12125550100", "NANP", "any", True), ("+999 1234567", "9991234567", None, None, False),
    ("n/a", None, None, None, False), ("", None, None, None, False), (None, None, None, None, False), ("+", None, None, None, False),
    ("+62812x", None, None, None, False),
])
def test_numbering_plan(spark, number, digits, region, kind, valid):
    got = N.numbered(spark.createDataFrame([(number,)], "n string"), "n", N.plan(spark)).first()
    assert tuple(got)[1:] == (digits, region, kind, valid)


def test_a_plan_without_entries_and_clashing_columns(spark):
    df = spark.createDataFrame([("0812", 1)], "n string, prefix int")
    got = N.numbered(df, "n", N.plan(spark).limit(0), out="x").first()
    assert got.x_e164 == "62812" and got.x_valid is False and got.prefix == 1
    assert N.numbered(df, "n", N.plan(spark)).columns == ["n", "prefix", "phone_e164", "phone_region", "phone_kind", "phone_valid"]
