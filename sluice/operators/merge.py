"""Keyed latest-version merge, dedup, conformance (SNK-2..4, AG-4, AG-5, SO-1).

``latest_per_key`` keeps, per key, the row with the greatest version; ties
are broken by a source priority (later insert wins, as a replacing merge
engine does) and then by the whole row, so the result is deterministic.

It is an aggregate, not a window: ``groupBy(key).agg(max(struct(version,
priority, *row)))``.  Spark runs it as a partial aggregation on every map
task before the shuffle, so a key that holds a third of all rows is reduced
to one row per map task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PRIORITY = "__sluice_priority"
_BEST = "__sluice_best"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(
    df: DataFrame,
    key="id",
    version: str = "updated_at",
    priority: str | None = None,
    drop_null_versions: bool = True,
) -> DataFrame:
    """AG-5 / SNK-4: one row per key, the one with the greatest ``version``.

    Rows with a NULL version are removed first when ``drop_null_versions``
    (PF-7 runs before dedup, so an id is never lost to its null copy).
    Ordering of the tie-break: version, then ``priority`` (higher wins), then
    the remaining columns in schema order (greater wins, NULLs lowest).
    """
    keys = _keys(key)
    src = df.where(F.col(version).isNotNull()) if drop_null_versions else df
    rest = [c for c in df.columns if c not in keys and c != version and c != priority]
    order = [F.col(version)] + ([F.col(priority)] if priority else []) + [F.col(c) for c in rest]
    names = [version] + ([priority] if priority else []) + rest
    best = F.max(F.struct(*[o.alias(n) for o, n in zip(order, names)])).alias(_BEST)
    out = src.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"{_BEST}.{n}").alias(n) for n in names]).select(*df.columns)


def split_touched(unique: DataFrame, changes: DataFrame, key="id") -> tuple[DataFrame, DataFrame]:
    """Split ``unique`` (one row per key) into the rows whose key does not
    occur in ``changes`` and those whose key does: anti and semi joins
    against the distinct keys of ``changes``.  Spark chooses by bytes
    whether those keys are broadcast (then ``unique`` is not shuffled).
    Keys compare null-safely, as grouping does."""
    from functools import reduce

    keys = _keys(key)
    touched = changes.select(*[F.col(k).alias(f"__touched_{k}") for k in keys]).distinct()
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__touched_{k}")) for k in keys])
    return unique.join(touched, match, "left_anti"), unique.join(touched, match, "left_semi")


def merge_latest(current: DataFrame, incoming: DataFrame, key="id", version: str = "updated_at",
                 current_unique: bool = False) -> DataFrame:
    """SNK-4 + SO-1: curated ∪ batch, then the latest version per key; on an
    equal version the incoming row wins (last insert), as a replacing
    merge tree keeps the last inserted row.

    ``current_unique=True`` declares that ``current`` has one row per key
    (a curated table).  Then only the keys the batch touches are merged:
    the other current rows pass through an anti join, so the current table
    is not shuffled where the touched keys are small enough in bytes to be
    broadcast.  The result is the same."""
    cur = current.select(*incoming.columns).withColumn(_PRIORITY, F.lit(0))
    new = incoming.withColumn(_PRIORITY, F.lit(1))
    if not current_unique:
        merged = latest_per_key(cur.unionByName(new), key=key, version=version, priority=_PRIORITY,
                                drop_null_versions=False)
        return merged.drop(_PRIORITY)
    untouched, contested = split_touched(cur, incoming, key)
    merged = latest_per_key(contested.unionByName(new), key=key, version=version, priority=_PRIORITY,
                            drop_null_versions=False)
    return untouched.unionByName(merged).drop(_PRIORITY)


def distinct_rows(df: DataFrame) -> DataFrame:
    """AG-4: full-row ``SELECT DISTINCT *`` (hash aggregate with partial
    aggregation, so repeated copies collapse before the shuffle)."""
    return df.distinct()


def parse_columns(columns) -> list[tuple[str, str]]:
    """``{'col': 'type', ...}`` / list of pairs / DDL string -> ordered pairs."""
    if isinstance(columns, str):
        return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(columns).fields]
    if isinstance(columns, dict):
        return list(columns.items())
    return [tuple(p) for p in columns]


def conform(df: DataFrame, columns, allow_missing: bool = False) -> DataFrame:
    """SNK-2 / QA-3: project to the declared columns, in order, each cast
    with ``try_cast`` (a value that does not fit becomes NULL)."""
    pairs = parse_columns(columns)
    missing = [c for c, _ in pairs if c not in df.columns]
    if missing and not allow_missing:
        raise ValueError(f"columns missing from batch: {missing}")
    return df.select(
        *[
            (F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c)
            for c, t in pairs
        ]
    )


def conform_violations(df: DataFrame, columns) -> DataFrame:
    """QA-3: one row per declared or present column: ``column_name, status
    ('ok' | 'missing' | 'extra'), declared_type, failed_casts``.

    ``failed_casts`` counts non-NULL values that ``try_cast`` turns into
    NULL; all counts come from a single aggregate job over the batch.
    """
    pairs = parse_columns(columns)
    present = [(c, t) for c, t in pairs if c in df.columns]
    spark = df.sparkSession
    if present:
        counts = df.agg(
            *[
                F.sum(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), 1).otherwise(0))
                .cast("bigint")
                .alias(f"f{i}")
                for i, (c, t) in enumerate(present)
            ]
        )
        stacked = counts.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("column_name"), F.lit("ok").alias("status"),
                                 F.lit(t).alias("declared_type"), F.col(f"f{i}").alias("failed_casts"))
                        for i, (c, t) in enumerate(present)
                    ]
                )
            ).alias("v")
        ).select("v.*")
    else:
        stacked = None
    rows = [(c, "missing", t, None) for c, t in pairs if c not in df.columns]
    declared = {c for c, _ in pairs}
    rows += [(c, "extra", None, None) for c in df.columns if c not in declared]
    schema = "column_name string, status string, declared_type string, failed_casts bigint"
    if rows:
        extra = spark.createDataFrame(rows, schema)
        return extra if stacked is None else stacked.unionByName(extra)
    return stacked if stacked is not None else spark.createDataFrame([], schema)


def cluster_by_key(df: DataFrame, key="id", num_partitions: int | None = None) -> DataFrame:
    """Optional ``ORDER BY (id)`` table clustering before a curated write:
    range partitions on the key, sorted within each partition."""
    keys = _keys(key)
    parts = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return parts.sortWithinPartitions(*keys)


def select_keep(df: DataFrame, keep: Sequence[str] | dict) -> DataFrame:
    """PF-8: keep columns in registry order."""
    names = list(keep.keys()) if isinstance(keep, dict) else list(keep)
    return df.select(*names)
