"""Bounded incremental batches (SRC-1..3, TK-1, AG-1, PF-1..6).

A batch is the rows whose version column lies in ``(start, cutoff]`` (or
``[start, cutoff]`` for backfill), where ``cutoff`` is the version of the
``cap``-th oldest row after ``start``; every row tied at the cutoff is
included, so a batch may exceed the cap.

The cutoff is found without sorting the table or pulling ``cap`` rows into
one task: an exact histogram refinement over the version's microseconds.
Each level is one aggregate job (partial aggregation on every executor)
that returns at most ``fanout`` bucket counts; the bucket crossing the cap
becomes the next level's range.  Ranges shrink to the observed min/max of
the crossing bucket, so coarse (e.g. daily) versions finish in one or two
levels; the worst case is ``ceil(log_fanout(range_us))`` levels.  Every
level filters on the raw column with literal bounds, so the filters reach
the parquet scan (row-group pruning) or the JDBC query.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from sluice.functions.common import as_col

DEFAULT_FANOUT = 4096
# Fixed values from the reference: per-run batch cap, minimum batch size,
# epoch used when no bookmark exists, and the version floor.
REFERENCE_BATCH_CAP = 10_000_000
REFERENCE_MIN_ROWS = 100
EPOCH = "1970-01-01 00:00:00"
VERSION_FLOOR = "2000-01-01 00:00:00"
DATE_FLOOR = "1900-01-01"

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
_DAY_US = 86_400_000_000
#: The version in microseconds, in a source that ``by_version`` stored.
STORED_US = "__sluice_us"
#: Rows of such a source that a task reads at least.
TASK_ROWS = 100_000


def _kind(df: DataFrame, column: str) -> str:
    dt = df.schema[column].dataType
    if isinstance(dt, TimestampNTZType):
        return "ntz"
    if isinstance(dt, TimestampType):
        return "ltz"
    if isinstance(dt, DateType):
        return "date"
    raise TypeError(f"version column {column!r} must be a timestamp or date, got {dt.simpleString()}")


def micros_of(df: DataFrame, column: str) -> Column:
    """Exact microseconds since the epoch, independent of session time zone."""
    kind = _kind(df, column)
    c = F.col(column)
    if kind == "ltz":
        return F.unix_micros(c)
    if kind == "date":
        c = c.cast("timestamp_ntz")
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{column}`)") if kind == "ntz" else F.expr(
        f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, cast(`{column}` as timestamp_ntz))"
    )


def literal_at(df: DataFrame, column: str, micros: int) -> Column:
    """A literal of the column's own type at ``micros`` since the epoch."""
    kind = _kind(df, column)
    if kind == "ltz":
        return F.expr(f"timestamp_micros({int(micros)})")
    ntz = F.expr(f"timestampadd(MICROSECOND, {int(micros)}, {_EPOCH_NTZ})")
    return ntz.cast("date") if kind == "date" else ntz


def parse_start(df: DataFrame, column: str, start) -> int | None:
    """Bookmark (str, date, datetime or None) -> microseconds since epoch."""
    if start is None:
        return None
    if isinstance(start, str):
        start = _dt.datetime.fromisoformat(start)
    if isinstance(start, _dt.date) and not isinstance(start, _dt.datetime):
        start = _dt.datetime(start.year, start.month, start.day)
    if start.tzinfo is not None:
        start = start.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    delta = start - _dt.datetime(1970, 1, 1)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def after(df: DataFrame, column: str, start_us: int | None, inclusive: bool = False) -> Column:
    if start_us is None:
        return F.col(column).isNotNull()
    lit = literal_at(df, column, start_us)
    return F.col(column) >= lit if inclusive else F.col(column) > lit


def cap_cutoff(df: DataFrame, column: str, start_us: int | None, cap: int, fanout: int = DEFAULT_FANOUT) -> int | None:
    """Microseconds of the ``cap``-th oldest version after ``start`` (exclusive);
    the newest version when fewer rows qualify; None when none do."""
    return cap_cutoff_rows(df, column, start_us, cap, fanout)[0]


def cap_cutoff_rows(df: DataFrame, column: str, start_us: int | None, cap: int,
                    fanout: int = DEFAULT_FANOUT) -> tuple[int | None, int]:
    """``(cutoff_us, rows)``: the cutoff and the exact number of rows in
    ``(start, cutoff]`` (ties at the cutoff included)."""
    if cap < 1:
        raise ValueError("cap must be >= 1")
    scope = df.select(column).where(after(df, column, start_us))
    us = micros_of(df, column)
    stats = scope.agg(F.count(F.lit(1)).alias("n"), F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    if stats is None or not stats["n"]:
        return None, 0
    if stats["n"] <= cap:
        return int(stats["hi"]), int(stats["n"])
    lo, hi, before, rows = int(stats["lo"]), int(stats["hi"]), 0, int(stats["n"])  # answer lies in [lo, hi]
    while lo < hi:
        width = -(-(hi - lo + 1) // fanout)
        level = (
            scope.where((F.col(column) >= literal_at(df, column, lo)) & (F.col(column) <= literal_at(df, column, hi)))
            .groupBy(F.floor((us - F.lit(lo)) / F.lit(width)).alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(us).alias("lo"), F.max(us).alias("hi"))
            .collect()  # at most `fanout` rows
        )
        for row in sorted(level, key=lambda r: r["b"]):
            if before + row["n"] >= cap:
                lo, hi, rows = int(row["lo"]), int(row["hi"]), before + int(row["n"])
                break
            before += row["n"]
        else:  # pragma: no cover - counts are exact, so a bucket always crosses
            raise RuntimeError("cutoff refinement lost rows")
    return lo, rows


@dataclass(frozen=True)
class BatchWindow:
    """A resolved batch: literal bounds, applied with ``apply``."""

    column: str
    start_us: int | None
    cutoff_us: int | None
    inclusive_start: bool = False
    rows: int | None = None  # rows in (start, cutoff]; None when unknown

    @property
    def empty(self) -> bool:
        return self.cutoff_us is None

    def condition(self, df: DataFrame) -> Column:
        if self.cutoff_us is None:
            return F.lit(False)
        upper = F.col(self.column) <= literal_at(df, self.column, self.cutoff_us)
        within = after(df, self.column, self.start_us, self.inclusive_start) & upper
        if STORED_US not in df.columns:
            return within
        within = within & (F.col(STORED_US) <= self.cutoff_us)
        if self.start_us is None:
            return within
        day = self.start_us % _DAY_US if _kind(df, self.column) == "date" else 0
        return within & (F.col(STORED_US) >= self.start_us - day)

    def apply(self, df: DataFrame) -> DataFrame:
        """The rows of the window; of a source that ``by_version`` stored, without what that added and in as many
        tasks as they need, for all but a window's pages are skipped there."""
        rows = df.where(self.condition(df))
        if STORED_US not in df.columns:
            return rows
        rows = rows.drop(STORED_US)
        return rows if self.rows is None else rows.coalesce(max(1, -(-self.rows // TASK_ROWS)))

    def cutoff_literal(self, df: DataFrame) -> Column:
        if self.cutoff_us is None:
            return F.lit(None).cast(df.schema[self.column].dataType)
        return literal_at(df, self.column, self.cutoff_us)


def resolve_window(
    df: DataFrame,
    version: str = "updated_at",
    start=None,
    cap: int = REFERENCE_BATCH_CAP,
    mode: str = "incremental",
    offset_ms: int = 0,
    fanout: int = DEFAULT_FANOUT,
    known: Mapping[int | None, BatchWindow] | None = None,
) -> BatchWindow:
    """SRC-1..3 + PF-1: resolve ``(start, cutoff]`` (incremental) or
    ``[start, cutoff]`` (backfill).

    ``known`` has windows of the same source and cap by their start
    (``known_windows``): an incremental one of them is not searched again.

    ``offset_ms=1`` reproduces the reference's bookmark + 1 ms start; the
    default reads strictly after the bookmark at full precision (D3).  The
    cutoff is always computed with an exclusive start, as the reference's
    bounds query is.
    """
    if mode not in ("incremental", "backfill"):
        raise ValueError(f"unknown batch mode {mode!r}")
    start_us = parse_start(df, version, start)
    if start_us is not None:
        start_us += offset_ms * 1000
    if known and mode == "incremental" and start_us in known:
        return known[start_us]
    cutoff, rows = cap_cutoff_rows(df, version, start_us, cap, fanout)
    if mode == "backfill" and start_us is not None and cutoff is not None:
        rows += df.where(F.col(version) == literal_at(df, version, start_us)).count()
    return BatchWindow(version, start_us, cutoff, inclusive_start=(mode == "backfill"), rows=rows)


def drain_windows(df: DataFrame, version: str = "updated_at", cap: int = REFERENCE_BATCH_CAP, ranges: int | None = None) -> Iterator[BatchWindow]:
    """Consecutive capped windows from the first version on, until the table
    is read.  All cutoffs come from one scan (``operators.cutoffs``); the
    driver holds a number per window, as the loop over them does."""
    from sluice.operators.cutoffs import all_cutoffs

    start_us = None
    for row in all_cutoffs(df, micros_of(df, version), cap, ranges).orderBy("cutoff_us").collect():
        yield BatchWindow(version, start_us, row["cutoff_us"], rows=row["rows"])
        start_us = row["cutoff_us"]


def known_windows(df: DataFrame, version: str = "updated_at", cap: int = REFERENCE_BATCH_CAP) -> dict[int | None, BatchWindow]:
    """The windows of a drain by their start in microseconds, for the runs that read them one after the other."""
    return {w.start_us: w for w in drain_windows(df, version, cap)}


def by_version(df: DataFrame, version: str = "updated_at") -> DataFrame:
    """The rows of ``df``, computed once and stored in order of their versions, for a source that many windows are read from.

    They carry their version in microseconds (``STORED_US``): Spark's parquet reader skips row groups and pages by a
    number, but not by a timestamp without zone.  ``BatchWindow.apply`` uses it and drops it.
    """
    from sluice.session import shared_dir

    path = shared_dir(df.sparkSession, "by-version")
    out = df.withColumn(STORED_US, micros_of(df, version).cast("long"))
    out.repartitionByRange(STORED_US).sortWithinPartitions(STORED_US).write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def batch_bounds(df: DataFrame, window: BatchWindow, id_col: str = "id") -> DataFrame:
    """AG-1: one row ``lower_bound, upper_bound, batch_cutoff, batch_rows``.

    The id bounds cover the whole window (ties included), so they are
    deterministic; the reference took them over an arbitrary tie-break.
    """
    return window.apply(df).agg(
        F.min(id_col).alias("lower_bound"),
        F.max(id_col).alias("upper_bound"),
        F.max(window.column).alias("batch_cutoff"),
        F.count(F.lit(1)).alias("batch_rows"),
    )


def next_start(bookmark, offset_ms: int = 1) -> Column:
    """PF-1 as a column over a TIMESTAMP_NTZ bookmark: bookmark + ``offset_ms``
    (default 1 ms, as the reference), truncated to milliseconds; a NULL
    bookmark -> the epoch."""
    b = as_col(bookmark)
    us = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), b) + F.lit(int(offset_ms) * 1000)
    ms_us = us - F.pmod(us, F.lit(1000))
    moved = F.timestamp_add("MICROSECOND", ms_us, F.expr(_EPOCH_NTZ))
    return F.coalesce(moved, F.expr(_EPOCH_NTZ))


def add_audit_columns(df: DataFrame) -> DataFrame:
    """PF-3: ``extracted_at`` / ``extract_date`` audit columns."""
    return df.withColumns({"extracted_at": F.current_timestamp(), "extract_date": F.current_date()})


def null_before(c, floor: str = DATE_FLOOR) -> Column:
    """PF-4: values earlier than ``floor`` become NULL."""
    c = as_col(c)
    return F.when(c < F.lit(floor).cast("date"), F.lit(None)).otherwise(c)


def floor_version(c, floor: str = VERSION_FLOOR) -> Column:
    """PF-5: values earlier than ``floor`` are raised to it; NULL stays NULL
    (``greatest`` would not keep NULLs)."""
    c = as_col(c)
    lit = F.expr(f"TIMESTAMP_NTZ '{floor}'")
    return F.when(c < lit, lit).otherwise(c)


def source_fixes(
    df: DataFrame,
    null_before_cols=(),
    floor_cols=("created_at", "updated_at"),
    filter_deleted: bool = False,
    deleted_col: str = "deleted",
) -> DataFrame:
    """PF-4..6 in one projection + filter."""
    changes = {c: null_before(c) for c in null_before_cols}
    for c in floor_cols:
        if c in df.columns:
            changes[c] = floor_version(changes.get(c, F.col(c)))
    out = df.withColumns(changes) if changes else df
    if filter_deleted:
        out = out.where(F.col(deleted_col) == F.lit(False))  # NULL is dropped too
    return out


def gate(batch_rows, min_rows: int = 1):
    """PF-2: whether a batch is big enough to load (reference threshold 100); a number or a column."""
    return batch_rows >= min_rows
