"""Late rows (SRC-2, ST-8): rows at or below the bookmark that no batch read.

A bookmark promises that every row up to it has been read.  A row that arrives
later with an older version breaks the promise and would be lost.  Source and
read rows are compared by checksums per time bucket: the number of rows and the
sum of their hashes, which do not depend on order and are summed before the
shuffle.  Only buckets that differ are read again, between literal bounds that
reach the scan, and an anti join finds the rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.batch import literal_at, micros_of, parse_start
from sluice.session import shared_dir

_BUCKET = "__late_bucket"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _bucketed(df: DataFrame, version: str, bookmark_us: int, bucket: str) -> DataFrame:
    up_to = df.where(F.col(version) <= literal_at(df, version, bookmark_us))
    return up_to.withColumn(_BUCKET, F.date_trunc(bucket, version).cast("timestamp_ntz"))


def _sums(df: DataFrame, hashed: list[Column], side: str) -> DataFrame:
    return df.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(f"{side}_rows"),
                                   F.sum(F.xxhash64(*hashed).cast("decimal(38,0)")).alias(f"{side}_sum"))


def differing_buckets(source: DataFrame, read: DataFrame, bookmark, key="id", version: str = "updated_at", bucket: str = "day") -> DataFrame:
    """(bucket, source_rows, read_rows) of the buckets up to ``bookmark`` whose rows are not the same ones."""
    at = parse_start(source, version, bookmark)
    hashed = lambda df: [*[F.col(k) for k in _keys(key)], micros_of(df, version)]
    s = _sums(_bucketed(source, version, at, bucket), hashed(source), "source")
    r = _sums(_bucketed(read, version, at, bucket), hashed(read), "read")
    j = s.join(r, _BUCKET, "full")
    same = F.col("source_rows").eqNullSafe(F.col("read_rows")) & F.col("source_sum").eqNullSafe(F.col("read_sum"))
    return j.where(~same).select(F.col(_BUCKET).alias("bucket"), F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
                                 F.coalesce("read_rows", F.lit(0)).alias("read_rows"))


def late_rows(source: DataFrame, read: DataFrame, bookmark, key="id", version: str = "updated_at", bucket: str = "day") -> DataFrame:
    """Rows of ``source`` up to ``bookmark`` that ``read`` has no row of the same key and version for.

    ``read`` is what earlier batches read (for example the landing), with key
    and version as in the source.  A source row of which ``read`` has one copy
    and the source two counts as read.
    """
    spark, keys = source.sparkSession, [*_keys(key), version]
    path = shared_dir(spark, "late-buckets")
    differing_buckets(source, read, bookmark, key, version, bucket).write.parquet(path)
    buckets = spark.read.parquet(path).select(F.col("bucket").alias(_BUCKET))
    low, high = buckets.agg(F.min(_BUCKET), F.max(_BUCKET)).first()
    if low is None:
        return source.limit(0)
    at = parse_start(source, version, bookmark)

    def again(df: DataFrame) -> DataFrame:
        first = literal_at(df, version, parse_start(df, version, low))
        beyond = F.date_trunc(bucket, F.col(version)).cast("timestamp_ntz") <= F.lit(high).cast("timestamp_ntz")
        return _bucketed(df.where(F.col(version) >= first), version, at, bucket).where(beyond).join(buckets, _BUCKET, "left_semi").drop(_BUCKET)

    known = again(read).select(*[F.col(c).alias(f"__read_{c}") for c in keys])
    match: Sequence[Column] = [F.col(c).eqNullSafe(F.col(f"__read_{c}")) for c in keys]
    return again(source).join(known, reduce(lambda a, b: a & b, match), "left_anti")
