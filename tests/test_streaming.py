"""Structured Streaming incremental load: the checkpoint is the bookmark, a
re-run processes nothing twice, newly landed files are picked up, and the
curated table equals a one-shot latest-per-key over everything landed."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sluice.operators.merge import latest_per_key
from sluice.plans.spec import TableSpec
from sluice.session import shared_dir
from sluice.sources import curated as K
from sluice.streaming.incremental import stream_landing_to_curated

SPEC = TableSpec.from_dict("events", {
    "transformation_order": ["upper", "keep_columns"],
    "upper": ["event_type"],
    "keep_columns": {"id": "bigint", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
                     "event_type": "string", "event_id": "bigint"},
})


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_is_incremental_and_exactly_once(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("user_id").alias("id"), F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
        "event_type", "event_id", F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int").alias("b"))
    landing, curated, ckpt = (shared_dir(spark, n) for n in ("s-landing", "s-curated", "s-ckpt"))

    def land(b):
        e.where(F.col("b") == b).drop("b").write.mode("overwrite").parquet(f"{landing}/batch={b}")

    def expected(upto):
        seen = e.where(F.col("b") <= upto).drop("b").withColumn("event_type", F.upper(F.trim("event_type")))
        return rows(latest_per_key(seen, key="id", version="updated_at"))

    def final():
        return rows(K.read(spark, curated).select(*SPEC.keep_columns))

    land(0)
    land(1)
    schema = spark.read.parquet(landing).schema
    stream_landing_to_curated(spark, landing, schema, SPEC, curated, ckpt)
    assert final() == expected(1)
    version = K.current_version(spark, curated)

    stream_landing_to_curated(spark, landing, schema, SPEC, curated, ckpt)  # nothing new landed
    assert K.current_version(spark, curated) == version and final() == expected(1)

    land(2)
    stream_landing_to_curated(spark, landing, schema, SPEC, curated, ckpt)
    assert final() == expected(2)


def test_a_fresh_checkpoint_loses_nothing(spark):
    curated = shared_dir(spark, "s-fresh")
    for n in (0, 1):
        landing = shared_dir(spark, "s-fresh-landing")
        df = spark.range(5 * n, 5 * n + 5).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' AS created_at",
                                                      "TIMESTAMP_NTZ '2024-01-01' AS updated_at", "'a' AS event_type", "id AS event_id")
        df.write.parquet(landing)
        stream_landing_to_curated(spark, landing, df.schema, SPEC, curated, shared_dir(spark, "s-fresh-ckpt"))
    assert sorted(r.id for r in K.read(spark, curated).collect()) == list(range(10))
