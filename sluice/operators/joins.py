"""Enrichment join (JN-1, JN-2, PF-10, DX-9).

The right table's columns are renamed ``<right_name>__<col>`` and pruned to
the join key, the requested columns and the filter columns before the join,
so the scan reads only those columns.  Physical strategy is Catalyst's /
AQE's (broadcast below ``spark.sql.autoBroadcastJoinThreshold`` measured at
runtime, sort-merge with skew splitting above it).
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import ensure_checkpoint_dir

SEP = "__"
_HOWS = {
    "inner", "outer", "full", "fullouter", "full_outer", "left", "leftouter", "left_outer",
    "right", "rightouter", "right_outer", "semi", "leftsemi", "left_semi", "anti", "leftanti", "left_anti",
}
_FILTERING = {"semi", "leftsemi", "left_semi", "anti", "leftanti", "left_anti"}


#: Joins that keep unmatched right rows, and the join that they are without those.
_WITHOUT_RIGHT = {**dict.fromkeys(("right", "rightouter", "right_outer"), "inner"),
                  **dict.fromkeys(("outer", "full", "fullouter", "full_outer"), "left")}
_SALT = "__sluice_salt"
#: Keys that are salted at most; any other has at most this share (1 / HOT_KEYS) of the rows.
HOT_KEYS = 10_000


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Keys with at least ``min_rows`` rows, the ``HOT_KEYS`` largest of them
    (a partial aggregate and a distributed top-k).  A key with a NULL matches
    nothing and is never listed."""
    counts = df.dropna("any", subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.where(F.col("__rows") >= min_rows).orderBy(F.desc("__rows")).limit(HOT_KEYS).select(*keys)


def _salted(left: DataFrame, right: DataFrame, lkeys, rkeys, how: str, buckets: int, min_rows: int) -> DataFrame:
    """Skew-safe equi-join: rows of a hot key are spread over ``buckets``
    salts, the right rows of hot keys are replicated once per salt, all
    other rows keep salt 0.  Every left row meets exactly the right rows it
    would meet unsalted, so the result is the plain join's, for inner / left
    / semi / anti joins.  Right and full joins are the salted inner or left
    join and, once each, the right rows that meet nothing: an anti join
    against the distinct left keys, which a hot key enters once.

    The salt is a hash of the row and its input partition: rows that are
    the same are spread too, and a retried task salts them as before.  Rows
    with a NULL key, which meet nothing, are spread likewise."""
    # The hot-key set is used twice; a reliable checkpoint in the shared folder
    # computes it with one pass over the left side.
    ensure_checkpoint_dir(left.sparkSession)
    hot = hot_keys(left, lkeys, min_rows).withColumn("__hot", F.lit(True)).checkpoint(eager=True)
    lh = left.join(F.broadcast(hot), list(lkeys), "left")
    no_key = reduce(lambda a, b: a | b, [left[k].isNull() for k in lkeys])
    spread = F.pmod(F.xxhash64(*[left[c] for c in left.columns], F.spark_partition_id()), F.lit(buckets))
    salt = F.when(F.coalesce(F.col("__hot"), F.lit(False)) | no_key, spread).otherwise(F.lit(0))
    ls = lh.withColumn(_SALT, salt.cast("int")).drop("__hot")
    hot_r = hot.select(*[F.col(lk).alias(rk) for lk, rk in zip(lkeys, rkeys)], "__hot")
    rh = right.join(F.broadcast(hot_r), list(rkeys), "left")
    salts = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    rs = rh.withColumn(_SALT, F.explode(salts)).drop("__hot")
    cond = ls[_SALT] == rs[_SALT]
    for lk, rk in zip(lkeys, rkeys):
        cond = cond & (ls[lk] == rs[rk])
    out = ls.join(rs, cond, _WITHOUT_RIGHT.get(how, how))
    keep = [ls[c] for c in left.columns] + ([] if how in _FILTERING else [rs[c] for c in right.columns])
    out = out.select(*keep)
    if how not in _WITHOUT_RIGHT:
        return out
    met = left.select(*[F.col(lk).alias(f"__met_{i}") for i, lk in enumerate(lkeys)]).dropna().distinct()
    alone = right.join(met, reduce(lambda a, b: a & b, [right[rk] == met[f"__met_{i}"] for i, rk in enumerate(rkeys)]), "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    return out.unionAll(alone.select(*nothing, *[F.col(c) for c in right.columns]))


def prefixed(right: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    cols = right.columns if columns is None else list(dict.fromkeys(columns))
    return right.select(*[F.col(c).alias(f"{name}{SEP}{c}") for c in cols])


def enrich(
    left: DataFrame,
    right: DataFrame,
    right_name: str,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str],
    how: str = "left",
    right_columns: Sequence[str] | None = None,
    filter_rows: Mapping[str, str] | None = None,
    replace_columns: Mapping[str, str] | None = None,
    salt_buckets: int | None = None,
    hot_key_rows: int = 1_000_000,
) -> DataFrame:
    """JN-1: ``left ⋈ right`` on equal keys; output = all left columns +
    ``<right_name>__<c>`` for each requested right column.

    ``filter_rows`` {left_col: right_col} keeps rows where the two are equal
    (PF-10; on an outer join this makes it effectively inner, which Catalyst
    exploits).  ``replace_columns`` {left_col: right_col} overwrites a left
    column with the right value where the right value is not NULL (DX-9).
    Semi and anti joins accept no right columns, filters or replacements.

    ``salt_buckets`` spreads hot keys (keys with at least ``hot_key_rows``
    left rows) over that many join tasks: see ``_salted``.
    """
    how = how.lower()
    if how not in _HOWS:
        raise ValueError(f"unknown join type {how!r}")
    lkeys = [left_on] if isinstance(left_on, str) else list(left_on)
    rkeys = [right_on] if isinstance(right_on, str) else list(right_on)
    if len(lkeys) != len(rkeys) or not lkeys:
        raise ValueError("left and right keys must pair up")
    wanted = list(right_columns or [])
    filter_rows = dict(filter_rows or {})
    replace_columns = dict(replace_columns or {})
    if how in _FILTERING and (wanted or filter_rows or replace_columns):
        raise ValueError("semi/anti joins cannot carry right columns, filters or replacements")
    needed = rkeys + wanted + list(filter_rows.values()) + list(replace_columns.values())
    r = prefixed(right, right_name, needed)
    if salt_buckets and salt_buckets > 1:
        joined = _salted(left, r, lkeys, [f"{right_name}{SEP}{k}" for k in rkeys], how, salt_buckets, hot_key_rows)
    else:
        cond = None
        for lk, rk in zip(lkeys, rkeys):
            term = left[lk] == r[f"{right_name}{SEP}{rk}"]
            cond = term if cond is None else cond & term
        joined = left.join(r, cond, how)
    for lc, rc in filter_rows.items():
        joined = joined.where(F.col(lc) == F.col(f"{right_name}{SEP}{rc}"))
    if how in _FILTERING:
        return joined
    # a union gives the left columns new identities
    of_left = F.col if salt_buckets and salt_buckets > 1 and how in _WITHOUT_RIGHT else left.__getitem__
    out = [
        (F.coalesce(F.col(f"{right_name}{SEP}{replace_columns[c]}"), of_left(c)).alias(c) if c in replace_columns else of_left(c))
        for c in left.columns
    ]
    out += [F.col(f"{right_name}{SEP}{c}") for c in wanted]
    return joined.select(*out)


def enrich_from(
    resolver: Callable[[str, bool], DataFrame],
    left: DataFrame,
    join_conf: Mapping,
) -> DataFrame:
    """JN-1 + JN-2 from a registry ``join`` block: ``with_table, how, left,
    right, right_table_columns?, filter_rows?, replace_columns?,
    clickhouse?``.  ``resolver(name, from_warehouse)`` returns the right
    table; the ``clickhouse`` key (any value) selects the warehouse side."""
    name = join_conf["with_table"]
    right = resolver(name, "clickhouse" in join_conf or bool(join_conf.get("warehouse")))
    return enrich(
        left,
        right,
        name,
        join_conf["left"],
        join_conf["right"],
        how=join_conf.get("how", "left"),
        right_columns=join_conf.get("right_table_columns"),
        filter_rows=join_conf.get("filter_rows"),
        replace_columns=join_conf.get("replace_columns"),
        salt_buckets=join_conf.get("salt_buckets"),
        hot_key_rows=join_conf.get("hot_key_rows", 1_000_000),
    )
