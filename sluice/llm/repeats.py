"""Long repeated substrings by merging Burrows-Wheeler transforms of shards.

Every ``LENGTH``-byte string holds one anchor: its q-gram of the smallest hash,
the leftmost on ties.  Equal strings have equal anchors at the same place, so
strings meet by anchor and most text, whose anchors occur once, never leaves
its document.  The strings around one anchor occurrence are one fragment;
equal fragments are one with a multiplicity.  Where an anchor has
different fragments, these are dealt into shards, each shard's
transform is built by itself, and the transforms are merged by refining their
interleave one letter at a time (stable partition by the preceding letter).
The rounds give the common prefixes: two neighbours still in one block after
``LENGTH`` rounds share that many bytes, and the blocks are the repeated
intervals.  No suffix of the merged set is compared or sorted again.

An anchor with more than ``MOST`` different fragments is split further: its
strings are dealt out one by one by their own hash and counted, so that no
task gathers them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, map_batches, passes, span_hashes, stored, texts

LENGTH = 200
GRAM = 64
#: Different fragments of an anchor that are merged in one task: at most 4096 * 336 bytes.
MOST = 4096
#: Bytes whose transform a shard holds, and bytes merged at a time.
SHARD, MERGE = 32 << 10, 256 << 10
#: A text is looked at in units of this many bytes, which overlap by LENGTH - 1.
UNIT = 8 << 20


def _units(raw: list[bytes]):
    """(text number, offset, piece) so that every LENGTH-byte string is in exactly one piece."""
    for i, b in enumerate(raw):
        if len(b) >= LENGTH:
            for at in range(0, len(b) - LENGTH + 1, UNIT):
                yield i, at, b[at:at + UNIT + LENGTH - 1]


def anchors(pieces: list[bytes]):
    """(piece, first string, last string, anchor hash, fragment hash) of every run of strings with one anchor."""
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begin = np.concatenate(([0], np.cumsum(size)))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    h = gram_hashes(data, GRAM)
    bits = np.uint64(max(1, len(data)).bit_length())
    low = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    span, width = LENGTH - GRAM + 1, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[:width - span], low[span - width:])
    at = (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)  # anchor of the string that starts here
    owner = np.repeat(np.arange(len(pieces)), size)[:len(at)]
    whole = np.arange(len(at)) + LENGTH <= begin[owner + 1]
    edge = np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(edge & whole)
    # runs end where the next anchor begins or the piece has no further string
    stop = np.minimum(np.concatenate((np.flatnonzero(edge), [len(at)]))[np.searchsorted(np.flatnonzero(edge), first, side="right")],
                      begin[owner[first] + 1] - LENGTH + 1)
    place = at[first] - first  # equal fragments must have the anchor at one place
    frag = span_hashes(data, first, stop + LENGTH - 1) ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    who = owner[first]
    return who, first - begin[who], stop - 1 - begin[who], h[at[first]].view(np.int64), frag.view(np.int64)


class Transform:
    """Burrows-Wheeler transform of the strings of one shard, each ended by a 0 of its own."""

    def __init__(self, strings: list[bytes]):
        size = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
        self.begin = np.cumsum(size) - size
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        # letters 1..256 and the end 0, so that a zero byte is not an end
        end = self.begin + size - 1
        letter = text.astype(np.int64) + 1
        letter[end] = 0
        n, rank, width = len(text), letter, 1
        to_end = np.repeat(end, size) - np.arange(n)
        while width < LENGTH:  # ranks by the first ``width`` letters, doubled
            far = np.where(to_end >= width, np.append(rank[width:], np.zeros(min(width, n), np.int64))[:n] + 1, 0)
            _, rank = np.unique(rank * (n + 300) + far, return_inverse=True)
            width *= 2
        self.order = np.argsort(rank, kind="stable")
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        before = np.arange(n) - 1
        before[self.begin] = end
        self.letter = letter[before[self.order]].astype(np.uint16)  # the transform
        self.back = place[before[self.order]]  # last-to-first: where the suffix that is one letter longer stands


def merge(shards: list[Transform], start: np.ndarray | None = None, rounds: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, block) of the shards' suffixes after refining by ``rounds`` letters.

    The interleave lists positions in the shards' transforms laid end to end;
    suffixes in one block share their first ``rounds`` letters.  With ``start``,
    ascending positions to begin with, only the suffixes that these lead to are
    followed, and one that is alone in its block is let go: whatever letters
    come before it, it stays alone.
    """
    size = np.array([len(s.order) for s in shards])
    base = np.cumsum(size) - size
    letter = np.concatenate([s.letter for s in shards])
    used = np.flatnonzero(np.bincount(letter, minlength=257))
    code = np.zeros(257, np.uint8 if len(used) <= 256 else np.uint16)
    code[used] = np.arange(len(used))
    letter = code[letter]
    back = np.concatenate([s.back + b for s, b in zip(shards, base)]).astype(np.int32)
    order = np.arange(len(letter), dtype=np.int32) if start is None else start.astype(np.int32)
    block = np.zeros(len(order), np.int32)
    for i in range(rounds):
        if not len(order):
            break
        own = letter[order]
        move = np.argsort(own, kind="stable")
        own, block, order = own[move], block[move], back[order[move]]
        fresh = np.concatenate(([True], (own[1:] != own[:-1]) | (block[1:] != block[:-1])))
        if start is not None and i % 4 == 3:
            keep = ~(fresh & np.append(fresh[1:], True))
            order, fresh = order[keep], fresh[keep]
        block = np.cumsum(fresh, dtype=np.int32)
    return order, block


def repeated(strings: list[bytes], times: np.ndarray) -> list[np.ndarray]:
    """For each string, which of its LENGTH-byte substrings occur more than once among all of them, counting ``times``."""
    shards, cut, size = [], [0], 0
    for i, s in enumerate(strings):
        size += len(s) + 1
        if size >= SHARD or i == len(strings) - 1:
            shards.append(Transform(strings[cut[-1]:i + 1]))
            cut.append(i + 1)
            size = 0
    length = np.array([len(s.order) for s in shards])
    text_at = np.concatenate([s.order + b for s, b in zip(shards, np.cumsum(length) - length)])
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(strings)), sizes)
    # LENGTH rounds lead from the place behind each substring to where it starts
    behind = np.arange(len(owner)) - begin[owner] >= LENGTH
    order, block = merge(shards, np.flatnonzero(behind[text_at]))
    hit = times[owner] > 1
    if len(order):
        at = text_at[order]
        hit[at] = np.bincount(block, weights=times[owner[at]])[block] > 1
    return [hit[b:b + max(0, n - LENGTH)] for b, n in zip(begin, sizes)]


def _runs(hit: np.ndarray) -> list[int]:
    """first, last, first, last ... of the runs of set places."""
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1], 1).ravel().tolist()


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _rows(docs: DataFrame) -> DataFrame:
    """A row is known by the hash of its id and text; rows that are the same have the same result."""
    return texts(docs).withColumn("row", F.xxhash64("doc_id", "text"))


def occurrences(docs: DataFrame) -> DataFrame:
    """(anchor, frag, row, first, last) of every fragment."""
    def run(batch):
        rows, raw = batch.column("row").to_pylist(), [_bytes(t) for t in batch.column("text").to_pylist()]
        units = list(_units(raw))
        for a, b in passes([u[2] for u in units], most=1 << 20):
            who, first, last, anchor, frag = anchors([u[2] for u in units[a:b]])
            unit = units[a:b]
            shift = np.array([u[1] for u in unit], np.int64)[who] if len(who) else np.empty(0, np.int64)
            key = np.array([rows[u[0]] for u in unit], np.int64)[who] if len(who) else np.empty(0, np.int64)
            yield {"anchor": pa.array(anchor), "frag": pa.array(frag), "row": pa.array(key),
                   "first": pa.array(first + shift), "last": pa.array(last + shift)}

    return map_batches(_rows(docs).where(F.octet_length("text") >= LENGTH).select("row", "text"), run, "anchor long, frag long, row long, first long, last long")


def _cut_out(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, frag, times, many, body): the bytes of one fragment of each kind."""
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "frag", "times", "many", "first", "last")).alias("cuts"))
    both = _rows(docs).join(lists, "row").select("text", "cuts")

    def run(batch):
        rows = []
        for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist()):
            raw = _bytes(text)
            rows += [(c["anchor"], c["frag"], c["times"], c["many"], raw[c["first"]:c["last"] + LENGTH]) for c in cuts]
        for a, b in passes(rows, lambda r: len(r[4])):
            cols = list(zip(*rows[a:b]))
            yield {"anchor": pa.array(cols[0], pa.int64()), "frag": pa.array(cols[1], pa.int64()), "times": pa.array(cols[2], pa.int64()),
                   "many": pa.array(cols[3], pa.bool_()), "body": pa.array(cols[4], pa.binary())}

    return map_batches(both, run, "anchor long, frag long, times long, many boolean, body binary")


def _merged(fragments: DataFrame) -> DataFrame:
    """(anchor, frag, runs): anchors come together and sorted, whole anchors are merged a bounded number of bytes at a time."""
    def run(batches):
        held: list[tuple] = []
        size = 0

        def settle(rows):
            hits = repeated([r[2] for r in rows], np.array([r[3] for r in rows], np.int64))
            out = [(r[0], r[1], runs) for r, h in zip(rows, hits) if r[3] == 1 and (runs := _runs(h))]
            cols = list(zip(*out)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64()))],
                                              names=["anchor", "frag", "runs"])

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "frag", "body", "times")]):
                if size >= MERGE and row[0] != held[-1][0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) + 1
        if held:
            yield settle(held)

    # rows of one row's repeats cut out the same fragment twice: one of each is enough
    one = fragments.dropDuplicates(["anchor", "frag"]).select("anchor", "frag", "body", "times")
    return one.repartition("anchor").sortWithinPartitions("anchor", "frag").mapInArrow(run, "anchor long, frag long, runs array<long>")


def _counted(fragments: DataFrame) -> DataFrame:
    """(anchor, frag, runs) for anchors with very many fragments: each string by its own hash."""
    def run(batch):
        for a, b in passes(batch.column("body").to_pylist(), lambda x: 64 * len(x)):
            part = batch.slice(a, b - a)
            bodies = part.column("body").to_pylist()
            size = np.fromiter(map(len, bodies), np.int64, len(bodies))
            begin, count = np.cumsum(size) - size, size - LENGTH + 1
            at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
            data = np.frombuffer(b"".join(bodies), np.uint8)
            who = np.repeat(np.arange(len(bodies)), count)
            take = lambda c: part.column(c).take(pa.array(who))
            yield {"anchor": take("anchor"), "frag": take("frag"), "times": take("times"),
                   "place": pa.array(at - begin[who]), "string": pa.array(span_hashes(data, at, at + LENGTH).view(np.int64))}

    one = fragments.dropDuplicates(["anchor", "frag"]).select("anchor", "frag", "times", "body")
    each = map_batches(one, run, "anchor long, frag long, times long, place long, string long")
    again = each.groupBy("anchor", "string").agg(F.sum("times").alias("n")).where("n > 1").select("anchor", "string")
    hit = each.where("times = 1").join(again, ["anchor", "string"], "left_semi")
    return hit.groupBy("anchor", "frag").agg(F.sort_array(F.collect_list("place")).alias("p")).select(
        "anchor", "frag", F.flatten(F.transform("p", lambda x: F.array(x, x))).alias("runs"))


def repeated_runs(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(row, first, last): strings that start at first .. last of a row's bytes occur elsewhere too."""
    every = occurrences(docs)
    # stored first: few are broadcast and many are joined with a shuffle of their own, whose hot anchors AQE splits
    twice = stored(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "twice")
    found = stored(every.join(twice, "anchor"), "anchors")
    kinds = found.groupBy("anchor", "frag").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "first", "last")).alias("at"))
    kinds = stored(kinds.select("anchor", "frag", "times", "at.*"), "kinds")
    groups = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = kinds.join(groups, "anchor").withColumn("many", F.col("kinds") > most)
    fragments = stored(_cut_out(docs, wanted), "fragments")
    part = _merged(fragments.where("not many")).unionAll(_counted(fragments.where("many")))
    whole = kinds.where("times > 1").select("anchor", "frag", F.array(F.lit(0).cast("long"), F.col("last") - F.col("first")).alias("runs"))
    runs = stored(part.unionAll(whole), "runs")
    hit = found.join(runs, ["anchor", "frag"]).select("row", "first", F.expr("explode(sequence(0, cast(size(runs) div 2 as int) - 1))").alias("i"), "runs")
    return hit.select("row", (F.col("first") + F.get("runs", F.col("i") * 2)).alias("first"), (F.col("first") + F.get("runs", F.col("i") * 2 + 1)).alias("last"))


def without_repeats(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) per document row.

    Null texts are empty; texts shorter than LENGTH bytes lose nothing; a row
    that occurs twice is its own repeat.  ``spans`` lists start, end of the
    removed runs in bytes.
    """
    runs = repeated_runs(docs, most).groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    both = _rows(docs).join(runs, "row", "left").select("doc_id", "text", "runs")

    def run(batch):
        rows = []
        for doc_id, text, own in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "runs")]):
            raw = _bytes(text)
            spans, kept, at = [], hashlib.sha256(), 0
            for first, last in sorted((r["first"], r["last"]) for r in own or []):
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], last + LENGTH)
                else:
                    spans.append([first, last + LENGTH])
            for a, b in spans:
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            rows.append((doc_id, len(raw), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [x for s in spans for x in s]))
        cols = list(zip(*rows)) or [()] * 6
        kinds = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.int64())]
        yield {n: pa.array(c, k) for n, c, k in zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"), cols, kinds)}

    return map_batches(both, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
