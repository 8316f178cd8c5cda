"""Helpers shared by the operators of this package."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import shared_dir

#: Bytes of text that one vectorised pass looks at; longer texts make a pass of their own.
PASS_BYTES = 1 << 20


def texts(docs: DataFrame) -> DataFrame:
    """The two columns the operators read, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch space and read it back.

    A later stage that loses an executor rereads the files instead of repeating what led to them.
    """
    path = shared_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` over column dicts: ``fn`` yields dicts of equally long columns."""

    def run(batches):
        for batch in batches:
            for cols in fn(batch):
                yield pa.RecordBatch.from_pydict(cols) if not isinstance(cols, pa.RecordBatch) else cols

    return df.mapInArrow(run, schema)


def passes(values: list, size=len, most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list into [from, to) ranges of about ``most`` in total size."""
    start = total = 0
    for i, v in enumerate(values):
        total += size(v) if v is not None else 0
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(values):
        yield start, len(values)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (a null id falls in fold -1)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def fold(doc_id: int | None, folds: int) -> int:
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of an unsigned 64-bit value (wraps on purpose)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: Two primes below 2**31, so that products fit 64 bits, and a base for each: a hash is a polynomial modulo both.
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1220703125)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**i modulo prime for i < n; a worker keeps them up to four passes' length."""
    have = _POWERS.get((base, prime))
    if have is None or len(have) < n:
        have = np.ones(n + (n >> 2) + (1 << 18), np.uint32)
        done = 1
        while done < len(have):
            more = min(done, len(have) - done)
            have[done:done + more] = have[:more].astype(np.uint64) * np.uint64(pow(base, done, prime)) % np.uint64(prime)
            done += more
        if n <= 4 * PASS_BYTES:
            _POWERS[base, prime] = have
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """A row per prime: sums of (data[i] + 1) * base**i, not reduced, so that differences of them are exact."""
    n = len(data)
    sums = np.zeros((len(_PRIMES), n + 1), np.uint64)
    values = data.astype(np.uint64) + np.uint64(1)
    wide = n * ((np.iinfo(data.dtype).max + 1) << 31) >= 1 << 64
    for row, base, prime in zip(sums, _BASES, _PRIMES):
        terms = values * _powers(base, prime, n)
        np.cumsum(terms % np.uint64(prime) if wide else terms, out=row[1:])
    return sums


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """Hash of data[start:end] for each pair of offsets; ``sums`` are the prefix sums if they are at hand."""
    sums = prefix_sums(data) if sums is None else sums
    both = []
    for row, base, prime in zip(sums, _BASES, _PRIMES):
        back = _powers(pow(base, -1, prime), prime, len(data) + 1)[start]
        both.append((row[end] - row[start]) % np.uint64(prime) * back % np.uint64(prime))
    with np.errstate(over="ignore"):
        return mix(mix(both[0] << np.uint64(31) ^ both[1]) + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """Hash of data[i:i+q] for every i."""
    n = len(data)
    if n < q:
        return np.empty(0, np.uint64)
    at = np.arange(n - q + 1)
    return span_hashes(data, at, at + q)
