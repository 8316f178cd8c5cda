"""Landing (staging) parquet: write a batch, read it back (SRC-5, SNK-1,
SNK-5, SNK-6, DX-10).

Each batch is written to its own ``batch_id=<id>`` directory with
``overwrite``, so a retried task or job rewrites the same files instead of
appending duplicates (the reference appended).  Partition directories come
from ``partitionBy``; before writing, rows are rebalanced on the partition
column with the ``REBALANCE`` hint so AQE splits a skewed value (one value
holding a third of the rows) into several files instead of one huge task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


#: Folder column of a partitioned landing.  The partition column itself stays in the
#: files, so its values, type and place never depend on what a folder name can say.
_FOLDER = "__landing_folder"


def _folder(column: str, value: Column) -> Column:
    """Folder name of a column's value; ``''`` and NULL differ, and no name looks like a number or a date."""
    return F.concat(F.lit(f"{column}="), F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("null")))


def batch_path(root: str, batch_id) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def write_landing(
    df: DataFrame,
    root: str,
    batch_id,
    partition_by: str | None = None,
    num_partitions: int | None = None,
) -> str:
    """SNK-1: write one batch (idempotent per ``batch_id``)."""
    path = batch_path(root, batch_id)
    if partition_by:
        out = df.withColumn(_FOLDER, _folder(partition_by, F.col(partition_by))).hint("rebalance", partition_by)
        writer = out.write.mode("overwrite").partitionBy(_FOLDER)
    else:
        out = df.repartition(num_partitions) if num_partitions else df.hint("rebalance")
        writer = out.write.mode("overwrite")
    writer.parquet(path)
    return path


def read_landing(
    spark: SparkSession,
    root: str,
    partition_key: str | None = None,
    partition_value=None,
    batch_id=None,
) -> DataFrame:
    """SRC-5: a whole landing table, one batch, or one ``key=value``
    partition.  The partition filter prunes directories at planning time and
    keeps the partition column (the reference's directory read dropped it).
    One batch is read from its own folder (``basePath`` keeps ``batch_id``
    and the partition columns), so only that batch's files are listed, not
    every batch ever landed."""
    if batch_id is not None:
        df = spark.read.option("basePath", root).parquet(batch_path(root, batch_id))
    else:
        df = spark.read.parquet(root)
    if partition_key is not None:
        kind = df.schema[partition_key].dataType
        value = F.lit(partition_value).cast(kind)
        # two floats can be equal and be written differently
        if _FOLDER in df.columns and not isinstance(kind, (FloatType, DoubleType)):
            other = ~F.col(_FOLDER).startswith(f"{partition_key}=")
            df = df.where((F.col(_FOLDER) == _folder(partition_key, value)) | other)
        df = df.where(F.col(partition_key) == value)
    return df.drop(_FOLDER)


#: Batches up to which their ids are broadcast.
BROADCAST_BATCHES = 100_000


def read_batches(spark: SparkSession, root: str, batches: DataFrame) -> DataFrame:
    """SRC-5 for the batches that a query chooses: the landed rows whose
    ``batch_id`` is in ``batches``.  The ids are broadcast after their number
    is checked, and dynamic partition pruning lets them choose the folders
    that are scanned; more ids are joined without."""
    landed = spark.read.parquet(root)
    kind = landed.schema["batch_id"].dataType
    # the condition holds for any id; dynamic pruning asks for a filter on the choosing side
    ids = batches.select(F.col("batch_id").cast(kind).alias("batch_id")).where(F.col("batch_id").cast("string") != "").distinct()
    if ids.limit(BROADCAST_BATCHES + 1).count() <= BROADCAST_BATCHES:
        ids = F.broadcast(ids)
    return landed.join(ids, "batch_id", "left_semi").drop(_FOLDER)


def reset(df_schema_source: DataFrame, path: str) -> None:
    """SNK-5 / SNK-6: replace a landing or staged table with an empty one
    of the same schema."""
    df_schema_source.limit(0).write.mode("overwrite").parquet(path)
