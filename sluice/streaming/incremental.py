"""Incremental cleaning as a Structured Streaming query.

The bookmark protocol of ``plans.run`` re-expressed with Spark's own
progress tracking: new landing files are the increment, the streaming
checkpoint is the bookmark, and each micro-batch is ruled, written to the
clean layer and merged into the key buckets it touches.  The write is keyed
by the data, not by the epoch: an epoch that is replayed after a failure
merges the same rows again, which changes nothing, and a stream that starts
over with a fresh checkpoint meets a filled table as any other batch does.
``availableNow`` drains what has landed and stops, which is how a
scheduled (daily / every-4-hours) run uses it; ``max_files_per_trigger``
bounds each micro-batch the way the row cap bounds a batch.
"""

from __future__ import annotations

import uuid
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluice.plans.run import ruled, load_clean
from sluice.plans.spec import TableSpec


def stream_landing_to_curated(
    spark: SparkSession,
    landing_root: str,
    schema: StructType | str,
    spec: TableSpec,
    curated_root: str,
    checkpoint_location: str,
    resolver: Callable[[str, bool], DataFrame] | None = None,
    custom: Mapping | None = None,
    max_files_per_trigger: int | None = None,
):
    """Start (and, with ``availableNow``, finish) the stream; returns the
    finished ``StreamingQuery``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(landing_root)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        load_clean(spark, ruled(batch, spec, resolver, custom), spec, curated_root, uuid.uuid4().hex)

    query = (stream.writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return query
