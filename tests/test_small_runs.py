"""What a capped run costs beside its rows: it reads its own window, searches and infers nothing twice, writes buckets side by side."""

import datetime as dt
import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators import batch as B
from sluice.operators import state as S
from sluice.plans.run import read_committed, run_batch
from sluice.plans.spec import TableSpec
from sluice.session import shared_dir
from sluice.sources import clean as C
from sluice.sources import curated as K

T0 = dt.datetime(2020, 1, 1)


def source(spark, n=3000, kind="timestamp_ntz"):
    """Versions an hour apart, ten rows without one."""
    return spark.range(n).selectExpr("id", f"cast(timestamp_ntz '2020-01-01' + make_dt_interval(0, cast(id as int)) as {kind}) as updated_at").unionAll(
        spark.range(n, n + 10).selectExpr("id", f"cast(null as {kind})"))


def rows_scanned(df) -> int:
    df.collect()
    plans, n = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        p = plans.pop()
        n += p.metrics().apply("numOutputRows").value() if p.nodeName().startswith("Scan parquet") else 0
        plans += [p.children().apply(i) for i in range(p.children().size())]
    return n


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_windows_of_a_stored_source_are_those_of_the_source(spark, kind):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        plain = source(spark, 700, kind)
        stored, start = B.by_version(plain, "updated_at"), None
        known = B.known_windows(stored, "updated_at", 90)
        while True:
            want = B.resolve_window(plain, "updated_at", start, 90)
            got = B.resolve_window(stored, "updated_at", start, 90, known=known)
            assert (got.start_us, got.cutoff_us, got.rows) == (want.start_us, want.cutoff_us, want.rows or 0)
            if want.empty:
                break
            for mode in (False, True):  # exclusive and inclusive starts, also inside a day
                for shift in (0, 1000):
                    at = None if want.start_us is None else want.start_us + shift
                    a, b = (B.BatchWindow("updated_at", at, want.cutoff_us, mode).apply(df) for df in (plain, stored))
                    assert b.columns == a.columns and sorted(a.collect()) == sorted(b.collect())
            start = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=want.cutoff_us)
        assert None in known and len(known) > 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_window_of_a_stored_source_reads_few_other_rows(spark):
    stored = B.by_version(source(spark, 400_000).repartition(4), "updated_at")
    window = B.BatchWindow("updated_at", 10**15 * 2, 10**15 * 2 + 500 * 3600 * 10**6, rows=500)
    batch = window.apply(stored)
    assert batch.count() == 500 and batch.rdd.getNumPartitions() == 1
    assert rows_scanned(window.apply(stored)) < 100_000


def test_single_update_is_a_local_relation_and_takes_times_as_they_read(spark):
    at = dt.datetime(2021, 5, 6, 7, 8, 9, 123456)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        upd = S.single_update(spark, "it's", "a\\b ?", status="idle", extracted_time=at, loaded_time=at.replace(tzinfo=dt.timezone.utc), curated_version=3)
        assert tuple(upd.first()) == ("it's", "a\\b ?", "idle", at, at, False, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert "LocalRelation" in upd._jdf.queryExecution().optimizedPlan().toString()
    assert [f.dataType.simpleString() for f in upd.schema] == ["string"] * 3 + ["timestamp_ntz"] * 2 + ["boolean", "bigint"]


def test_runs_of_known_windows_search_no_cutoff_and_infer_no_schema(spark, monkeypatch):
    spec = TableSpec.from_dict("t", {"transformation_order": [], "created": "updated_at", "keep_columns": {"id": "bigint", "updated_at": "timestamp_ntz"}})
    stored = B.by_version(source(spark, 300), "updated_at")
    windows, root, state = B.known_windows(stored, "updated_at", 100), shared_dir(spark, "t-known"), S.empty_state(spark)
    searched = []
    search = B.cap_cutoff_rows
    monkeypatch.setattr(B, "cap_cutoff_rows", lambda *a, **k: searched.append(1) or search(*a, **k))
    monkeypatch.setattr(C, "_schema", lambda *a: pytest.fail("the declared types are known"))
    distinct = DataFrame.distinct
    monkeypatch.setattr(DataFrame, "distinct", lambda self: pytest.fail("the buckets are known") if "__bucket" in self.columns else distinct(self))
    for n in range(1, 5):
        res = run_batch(spark, spec, "s", stored, state, root, cap=100, windows=windows)
        state = spark.createDataFrame(res.state.collect(), res.state.schema)
        assert (res.status, len(searched)) == (("SUCCESS", 0) if n < 4 else ("IDLE", 1))
    assert sorted(r.id for r in read_committed(spark, root, state, "s", "t").collect()) == list(range(300))


def test_the_clean_write_names_the_buckets_of_its_clean_rows(spark):
    root, rng = shared_dir(spark, "t-distinct"), random.Random(3)
    df = spark.createDataFrame([(i, str(rng.choice([1, 2, "x"]))) for i in range(60)] + [(None, "1")], "id long, amount string")
    bucket = K.bucket_of(["id"], 64, None)
    got = C.write(spark, df, root, "r", {"id": "bigint", "amount": "int"}, distinct=bucket)
    assert got["rejected"] and got["distinct"] == sorted({r[0] for r in df.where("amount <> 'x'").select(bucket).collect()})
    assert C.write(spark, df.limit(0), root, "none", {"id": "bigint"}, distinct=bucket) == {"clean": 0, "rejected": 0, "distinct": []}


def test_small_buckets_are_written_by_several_tasks(spark):
    root = shared_dir(spark, "t-small")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "true")
        K.merge(spark, spark.range(400).selectExpr("id", "timestamp_ntz '2020-01-01' as updated_at"), root)
    finally:
        spark.conf.set(name, before)
    files = K.read(spark, root).inputFiles()
    assert len(files) == K.BUCKETS and len({f.rsplit("/", 1)[1].split("-")[1] for f in files}) > 1  # names begin with the task
    assert sorted(r.id for r in K.read(spark, root).collect()) == list(range(400))


def test_expire_keeps_what_later_versions_name(spark):
    root = shared_dir(spark, "t-expire")
    for n in range(1, 6):
        K.merge(spark, spark.range(n * 10, n * 10 + 3).withColumn("updated_at", F.lit(T0 + dt.timedelta(days=n)).cast("timestamp_ntz")), root, width=10)
    assert K.expire(spark, root, keep=1) == 0
    assert K.expire(spark, root, keep=4) == 0 and K.read(spark, root, 4).count() == 12  # a bucket each: all are named
    K.merge(spark, K.read(spark, root), root)
    assert K.expire(spark, root, keep=6) == 5 and K.read(spark, root).count() == 15
