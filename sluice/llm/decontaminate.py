"""Benchmark passages in documents by the q-gram lemma.

An occurrence of an item of m bytes with at most k edits keeps at least
m - q + 1 - k*q of the item's q-grams, all on diagonals at most k apart.
Shared q-grams are counted in diagonal bands that overlap by half, so any k+1
neighbouring diagonals lie in one band; only bands that reach the bound go
to a banded alignment, which settles the match.

The benchmark is the stated query set: its items go to the workers in blocks
of ``BLOCK_BYTES`` of item text, so what a worker holds is bounded however large the
benchmark is; every block is run over all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, passes, texts

Q = 12
EDIT_RATE = 0.05
#: Item text that one block of the query set holds.
BLOCK_BYTES = 8 << 20
_BITS = 22
#: Positions whose q-grams are looked up at once, whatever the length of the text.
_CHUNK = 1 << 16

SCHEMA = "doc_id long, item_id long, start long, end long, edits long, item_length long"


def normal(text: str | None) -> bytes:
    """Lower case, blanks collapsed, as UTF-8."""
    return " ".join((text or "").lower().split()).encode("utf-8", "replace")


def gram_keys(data: np.ndarray, q: int) -> np.ndarray:
    """A key of data[i:i+q] for every i; unequal q-grams of one key only bring candidates that the alignment refuses."""
    n = max(0, len(data) - q + 1)
    keys = np.zeros(n, np.uint64)
    for j in range(q):
        keys *= np.uint64(0xA0761D6478BD642F)
        keys += data[j:j + n]
    return mix(keys)


def edit_budget(m: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed for an item of m bytes: the rate, as far as the lemma keeps two q-grams."""
    return max(0, min(int(rate * m), (m - q - 1) // q))


class Index:
    """q-grams of the benchmark items, sorted by hash."""

    def __init__(self, items: list[tuple[int, bytes]], q: int = Q, rate: float = EDIT_RATE):
        self.q, self.rate = q, rate
        self.items = [(i, b) for i, b in items if b]
        self.short = [(n, i, b) for n, (i, b) in enumerate(self.items) if len(b) < q]
        hashes, which, where = [], [], []
        for n, (_, b) in enumerate(self.items):
            h = gram_keys(np.frombuffer(b, np.uint8), q)
            hashes.append(h)
            which.append(np.full(len(h), n, np.int32))
            where.append(np.arange(len(h), dtype=np.int32))
        cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
        h = cat(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.off = h[order], cat(which, np.int32)[order], cat(where, np.int32)[order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hash >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        size = np.array([len(b) for _, b in self.items], np.int64)
        self.budget = np.array([edit_budget(m, q, rate) for m in size], np.int64)
        self.least = np.maximum(1, size - q + 1 - self.budget * q)

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions whose q-gram some item holds, the first of its entries, and how many there are."""
        found = [np.zeros((3, 0), np.int64)]
        for at in range(0, len(data), _CHUNK):
            h = gram_keys(data[at:at + _CHUNK + self.q - 1], self.q)
            pos = np.flatnonzero(self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(self.hash, h[pos], "left"), np.searchsorted(self.hash, h[pos], "right")
            found.append(np.stack((pos + at, lo, hi - lo))[:, hi > lo])
        pos, lo, n = np.concatenate(found, axis=1)
        return pos, lo, n

    def candidates(self, data: np.ndarray, begin: np.ndarray):
        """(document, item, lowest diagonal of the band) that reach the lemma's bound."""
        pos, lo, n = self.shared(data)
        entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item, diagonal = self.item[entry], np.repeat(pos, n) - self.off[entry]
        doc = np.searchsorted(begin, np.repeat(pos, n), side="right") - 1
        if not len(doc):
            return []
        width = self.budget[item] + 1
        shift = diagonal - begin[doc] + (1 << 20)  # a match may begin before the text: keep bands positive
        band = shift // width
        rows = np.concatenate([np.stack([doc, item, band]), np.stack([doc, item, band - 1])], axis=1)
        order = np.lexsort(rows[::-1])
        rows = rows[:, order]
        first = np.concatenate(([True], np.any(rows[:, 1:] != rows[:, :-1], axis=0)))
        at = np.flatnonzero(first)
        count = np.diff(np.append(at, rows.shape[1]))
        keep = at[count >= self.least[rows[1, at]]]
        return [(int(d), int(i), int(b) * int(self.budget[i] + 1) - (1 << 20)) for d, i, b in rows[:, keep].T]


_COST = np.int64(1) << np.int64(40)  # a cell holds edits * 2**40 + start + 2**30


def align(item: bytes, region: bytes, budget: int, base: int, width: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn ``item`` into a substring of ``region``, within the budget.

    Diagonals (region offset minus item offset) base - budget .. base + width + budget
    are looked at.  The region is padded with letters that equal none: pairing one
    costs as much as leaving the item's letter out.  Returns (edits, start, end)
    in the region, the smallest start and then the smallest end on ties.
    """
    m, n = len(item), len(region)
    lo, hi = base - budget, base + width + budget
    band = np.arange(lo, hi + 1, dtype=np.int64)
    w = len(band)
    letters = np.full(m + w, -1, np.int16)
    a, b = max(0, lo), min(n, lo + m + w)
    if a < b:
        letters[a - lo:b - lo] = np.frombuffer(region, np.uint8)[a:b]
    differs = letters[None, :] != np.arange(256, dtype=np.int16)[np.unique(np.frombuffer(item, np.uint8))][:, None]
    row_of = {c: differs[i].astype(np.int64) * _COST for i, c in enumerate(sorted(set(item)))}
    cell = band + (np.int64(1) << np.int64(30))
    right = np.arange(w, dtype=np.int64) * _COST
    up = np.full(w, (m + n + 2) * int(_COST), np.int64)
    stop = (budget + 1) * int(_COST)
    for i, c in enumerate(item):
        np.add(cell[1:], _COST, out=up[:-1])  # item letter left out
        cell = np.minimum(cell + row_of[c][i:i + w], up)
        cell = np.minimum.accumulate(cell - right) + right  # region letters inserted
        if i % 16 == 15 and cell.min() >= stop:
            return None
    at = int(cell.argmin())
    edits, start = divmod(int(cell[at]), int(_COST))
    if edits > budget:
        return None
    start = min(max(0, start - (1 << 30)), n)
    return edits, start, max(start, min(n, m + int(band[at])))


def find(index: Index, bodies: list[bytes]) -> list[tuple[int, int, int, int, int, int]]:
    """(document, item id, start, end, edits, item length) of the best match of each item in each text."""
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    sizes = np.array([len(b) for b in bodies], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))
    data = np.frombuffer(b"\0".join(bodies), np.uint8)
    for doc, n, low in index.candidates(data, begin):
        item, k = index.items[n][1], int(index.budget[n])
        best = out.get((doc, n))
        if best and best[0] == 0:
            continue
        a = max(0, low - k)
        b = min(int(sizes[doc]), low + 2 * k + 2 + len(item) + k)
        at = bodies[doc].find(item, a, b)  # on one diagonal, without an edit
        hit = (0, at - a, at - a + len(item)) if at >= 0 else align(item, bodies[doc][a:b], k, low - a, 2 * k + 1)
        if hit:
            found = (hit[0], a + hit[1], a + hit[2])
            out[doc, n] = min(best or found, found)
    for n, _, item in index.short:  # shorter than a q-gram: the lemma says nothing, no edits are allowed
        for doc, body in enumerate(bodies):
            if (at := body.find(item)) >= 0:
                out[doc, n] = (0, at, at + len(item))
    return [(doc, index.items[n][0], s, e, cost, len(index.items[n][1])) for (doc, n), (cost, s, e) in sorted(out.items())]


def blocks(benchmark: DataFrame, most: int):
    """The items in blocks of bounded text, streamed to the driver partition by partition."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, size = [], 0
    for r in rows.where(F.col("text").isNotNull()).orderBy("item_id", "text").toLocalIterator():
        body = normal(r["text"])
        if size + len(body) > most and block:
            yield block
            block, size = [], 0
        block.append((r["item_id"], body))
        size += len(body)
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row and benchmark item that occurs in it: the match with the fewest edits.

    Offsets are bytes of the lower-cased text with blanks collapsed.  Null or
    empty texts and items match nothing; items shorter than q bytes match only
    exactly; a repeated document row gives its matches again; items that share
    an id are reported one by one.
    """
    spark, out = docs.sparkSession, None
    for block in blocks(benchmark, block_bytes):
        index = spark.sparkContext.broadcast(Index(block, q, rate))

        def run(batches, index=index):
            for batch in batches:
                keys, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                rows = []
                for a, b in passes(bodies):
                    found = find(index.value, [normal(t) for t in bodies[a:b]])
                    rows += [(keys[a + r[0]], *r[1:]) for r in found]
                cols = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[
                    "doc_id", "item_id", "start", "end", "edits", "item_length"])

        part = texts(docs).mapInArrow(run, SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The document rows (all columns, unchanged) whose text holds no benchmark passage."""
    spark = docs.sparkSession
    for block in blocks(benchmark, how.get("block_bytes", BLOCK_BYTES)):
        index = spark.sparkContext.broadcast(Index(block, how.get("q", Q), how.get("rate", EDIT_RATE)))

        def run(batches, index=index):
            for batch in batches:
                bodies = batch.column("text").to_pylist()
                bad = np.zeros(len(bodies), bool)
                for a, b in passes(bodies):
                    bad[[a + r[0] for r in find(index.value, [normal(t) for t in bodies[a:b]])]] = True
                yield batch.filter(pa.array(~bad))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
