"""Structured Streaming variant of the incremental load."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog.registry import query, table
from sluice.plans.spec import TableSpec
from sluice.session import shared_dir
from sluice.sources import curated as K
from sluice.streaming.incremental import stream_landing_to_curated


@query("stream_landing", sql="""
    SELECT user_id AS id, ts AS created_at, ts AS updated_at, upper(trim(event_type)) AS event_type,
           CASE WHEN value = 0 THEN NULL ELSE value END AS value, event_id
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_landing(spark, sf):
    """Events landed as five daily-range batches, streamed through the rule
    runner micro-batch by micro-batch (one landing file set per trigger),
    merged into the key buckets it touches (latest per user)."""
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
        F.col("event_type"), F.col("value"), F.col("event_id"),
        F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(4)).cast("int").alias("landing_batch"))
    landing = shared_dir(spark, "stream-landing")
    e.write.mode("overwrite").partitionBy("landing_batch").parquet(landing)
    spec = TableSpec.from_dict("events", {
        "transformation_order": ["upper", "convert_zero_to_null", "keep_columns"],
        "upper": ["event_type"], "convert_zero_to_null": ["value"],
        "keep_columns": {"id": "bigint", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
                         "event_type": "string", "value": "double", "event_id": "bigint"},
    })
    schema = spark.read.parquet(landing).schema
    curated = shared_dir(spark, "stream-curated")
    stream_landing_to_curated(spark, landing, schema, spec, curated, shared_dir(spark, "stream-ckpt"),
                              max_files_per_trigger=8)
    return K.read(spark, curated)
