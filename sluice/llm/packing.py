"""Best-fit packing by minimum bin slack.

Only the histogram of piece lengths (at most ``capacity`` rows) reaches the
driver.  Per bin the longest length left is placed first and a bitset
subset-sum over the lengths left finds the fullest feasible rest.  Removing
that combination leaves it the fullest one for as long as its lengths last,
so equal bins are taken at once: each step uses up some length, and there
are at most ``capacity`` steps however many documents there are.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import from_json
from .common import PASS_BYTES, passes, span_hashes, stored, texts

CAPACITY = 4096
END_ID = 1
#: Distinct words whose ids a worker keeps between passes; beyond that it starts afresh.
KEPT_WORDS = 500_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def _classes() -> np.ndarray:
    """0 blank, 1 letter, 2 digit, 3 other for the code units below U+0240."""
    out = np.full(1 << 16, 3, np.uint8)
    for c in range(0x240):
        kind = unicodedata.category(chr(c))[0]
        out[c] = 1 if kind == "L" else 2 if kind == "N" else 3
    out[[*range(9, 14), 0x20, 0x85, 0xA0]] = 0
    return out


def _inside(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... start + size - 1 of each span, end to end."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class WordEncoder:
    """Token ids of many texts in one pass.

    Words are cut as the tokenizer's pattern cuts them, the distinct words of a
    pass are merged together, and the ids are gathered back in text order.  A
    text with letters beyond the Latin blocks, or with a special token, goes to
    the tokenizer itself, which gives the same ids more slowly.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_path)
        self.merges = from_json(tokenizer_path)
        self.kind = _classes()
        self._forget()

    def _slow(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        low = [t.lower() for t in texts]
        data = np.frombuffer(" ".join(low).encode("utf-16-le", "surrogatepass"), np.uint16)
        sizes = np.fromiter(map(len, low), np.int64, len(low))
        if len(data) != sizes.sum() + len(low) - 1:  # letters beyond the first plane
            sizes = np.fromiter((len(t.encode("utf-16-le", "surrogatepass")) // 2 for t in low), np.int64, len(low))
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))
        odd = np.flatnonzero((data >= 0x240) | (data >= 0x1C) & (data <= 0x1F))
        slow = set(np.searchsorted(begin, odd, side="right") - 1) if len(odd) else set()
        slow.update(i for i, t in enumerate(texts) if "<|" in t or "\u0130" in t)
        kind = self.kind[data]
        for i in slow:
            kind[begin[i]:begin[i + 1]] = 0
        start, end = self._words(data, kind)
        pool, first, count, inverse = self._encode(data, start, end)
        count = count[inverse]
        upto = np.concatenate(([0], np.cumsum(count)))
        ids = pool[np.repeat(first[inverse] - upto[:-1], count) + np.arange(upto[-1])]
        cut = upto[np.searchsorted(start, begin)]
        return [self._slow(texts[i]) if i in slow else ids[cut[i]:cut[i + 1]] for i in range(len(texts))]

    @staticmethod
    def _words(data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans of letter runs, single digits, other runs, and 's 't 're 've 'm 'll 'd."""
        n = len(data)
        before = np.concatenate(([0], kind[:-1])).astype(np.uint8)
        starts = (kind != 0) & ((kind != before) | (kind == 2))
        quote = np.flatnonzero((data == 0x27) & starts & (kind == 3))
        quote = quote[quote + 1 < n]
        if len(quote):
            one = data[quote + 1]
            two = np.where(quote + 2 < n, data[np.minimum(quote + 2, n - 1)], 0)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = np.isin(one.astype(np.int64) << 16 | two, [ord(a) << 16 | ord(b) for a, b in ("re", "ve", "ll")])
            for hit, past in ((quote[short], 2), (quote[long], 3)):
                starts[hit + 1] = False
                after = hit[hit + past < n] + past
                starts[after] |= kind[after] != 0
        at = np.flatnonzero(starts)
        # a word ends where the next begins or at the blank before it
        blank = np.concatenate((np.flatnonzero(kind == 0), [n]))
        end = np.minimum(np.concatenate((at[1:], [n])), blank[np.searchsorted(blank, at)])
        return at, end

    def _encode(self, data, start, end):
        """Pool of ids, where each distinct word's ids lie in it, and the distinct word of every word."""
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int64), np.empty(0, np.int64)
        hashes = span_hashes(data, start, end)
        order = np.argsort(hashes)
        hashes = hashes[order]
        fresh = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(fresh) - 1
        hashes, sample = hashes[fresh], order[fresh]
        new = ~self._known(hashes)
        if len(self.hashes) + np.count_nonzero(new) > KEPT_WORDS:
            self._forget()
            new[:] = True
        if new.any():
            self._learn(data, start[sample[new]], end[sample[new]], hashes[new])
        inverse = self.word[np.searchsorted(self.hashes, hashes)][inverse]
        # words of one hash are told apart by their units: those that differ from the word kept are merged by themselves
        other = self._unlike(data, start, end, inverse)
        if not len(other):
            return self.pool, self.at, self.count, inverse
        pool, first = self._merge_words(data, start[other], end[other])
        inverse[other] = len(self.at) + np.arange(len(other))
        return (np.concatenate((self.pool, pool)), np.concatenate((self.at, first[:-1] + len(self.pool))),
                np.concatenate((self.count, np.diff(first))), inverse)

    def _known(self, hashes) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        return np.append(self.hashes, np.uint64(0))[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)

    def _learn(self, data, start, end, hashes) -> None:
        """Keep the ids and the units of words that have new hashes (in order)."""
        pool, first = self._merge_words(data, start, end)
        size = end - start
        slot = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, slot, hashes)
        self.word = np.insert(self.word, slot, len(self.at) + np.arange(len(hashes)))
        self.begin = np.concatenate((self.begin, len(self.units) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.units = np.concatenate((self.units, data[_inside(start, size)]))
        self.at = np.concatenate((self.at, first[:-1] + len(self.pool)))
        self.count = np.concatenate((self.count, np.diff(first)))
        self.pool = np.concatenate((self.pool, pool))

    def _unlike(self, data, start, end, word) -> np.ndarray:
        """The words of a pass that are not, unit by unit, the word kept for their hash."""
        size = end - start
        same = size == self.size[word]
        pick = np.flatnonzero(same)
        size = size[pick]
        off = np.flatnonzero(data[_inside(start[pick], size)] != self.units[_inside(self.begin[word[pick]], size)])
        same[pick[np.searchsorted(np.cumsum(size), off, side="right")]] = False
        return np.flatnonzero(~same)

    def _forget(self) -> None:
        self.hashes, self.word = np.empty(0, np.uint64), np.empty(0, np.int64)  # by hash, and the word's number
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)  # the words' units, by number
        self.units = np.empty(0, np.uint16)
        self.at, self.count = np.empty(0, np.int64), np.empty(0, np.int64)  # the words' ids, by number
        self.pool = np.empty(0, np.uint32)

    def _merge_words(self, data, s, end):
        size = end - s
        upto = np.concatenate(([0], np.cumsum(size + 1)))  # with a blank after each word
        flat = np.full(upto[-1], 0x20, np.uint16)
        gap = np.ones(upto[-1], bool)
        gap[upto[1:] - 1] = False
        flat[gap] = data[_inside(s, size)]
        raw = np.frombuffer(flat.tobytes().decode("utf-16-le").encode(), np.uint8)
        ends = np.flatnonzero(raw == 0x20)
        begins = np.concatenate(([0], ends[:-1] + 1))
        return self.merges.encode(raw, begins, ends - begins)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``(part, length, nth)`` numbers the pieces of a length within a task.

    A null or empty text is the end id alone; a null ``doc_id`` stays null;
    repeated rows are packed as often as they occur.
    """
    tail = np.asarray([end_id], "<u4")

    def run(batches):
        enc, part, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, keys, bodies = [], batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in passes(bodies, most=2 * PASS_BYTES):
                for doc_id, ids in zip(keys[a:b], enc.ids([t or "" for t in bodies[a:b]])):
                    ids = np.concatenate((ids, tail)).astype("<u4", copy=False)
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start:start + capacity]
                        length = len(own)
                        rows.append((doc_id, piece, start, length, zlib.crc32(own), part, seen[length]))
                        seen[length] += 1
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return texts(docs).mapInArrow(run, PIECES)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """Subset of the lengths left (descending list) with the largest sum up to ``room``."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in lengths:
        most = min(counts[length], room // length) if length <= room else 0
        if not most:
            continue
        before, left, chunk = reach, most, 1
        while left:
            take = min(chunk, left)
            reach |= (reach << (take * length)) & mask
            left, chunk = left - take, chunk * 2
        if reach != before:
            steps.append((length, most, before))
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, []
    for length, most, before in reversed(steps):
        used = 0
        while not before >> at & 1:  # the fewest of this length that the earlier lengths can complete
            at, used = at - length, used + 1
        if used:
            out.append((length, used))
    return out


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """``[(bins, [(length, pieces per bin), ...]), ...]`` covering the histogram."""
    counts = {k: v for k, v in histogram.items() if v}
    lengths, out = sorted(counts, reverse=True), []
    while lengths:
        first = lengths[0]
        counts[first] -= 1
        rest = fullest([x for x in lengths if counts[x]], counts, capacity - first)
        counts[first] += 1
        per = Counter({first: 1})
        for length, n in rest:
            per[length] += n
        bins = min(counts[k] // n for k, n in per.items())
        out.append((bins, sorted(per.items(), reverse=True)))
        for k, n in per.items():
            counts[k] -= n * bins
        lengths = [x for x in lengths if counts[x]]
    return out


def slots(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, pieces per bin, first sequence, offset in the sequence), by rank."""
    taken, base, out = Counter(), 0, {}
    for bins, per in plan:
        offset = 0
        for length, n in per:
            out.setdefault(length, []).append((taken[length], n, base, offset))
            taken[length] += n * bins
            offset += n * length
        base += bins
    return {k: np.asarray(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces with the sequence and offset that they got."""
    spark = docs.sparkSession
    pieces = stored(cut_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(slots(plan_bins(histogram, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))

    def place(batches):
        table = places.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for own in np.split(order, cuts) if len(order) else []:
                rows = table[int(length[own[0]])]
                r = rank[own]
                hit = rows[np.searchsorted(rows[:, 0], r, side="right") - 1]
                past = r - hit[:, 0]
                seq[own] = hit[:, 2] + past // hit[:, 1]
                off[own] = hit[:, 3] + past % hit[:, 1] * length[own]
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(keep + [pa.array(seq), pa.array(off)], names=[
                "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
