"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line, and a long line is cut further where a word's hash says
so, so an edit changes few of them.  Each distinct paragraph digest is added to
three cells of a table (count, xor of digests, xor of check values), one in
each third; a third has ``2**level`` cells.  The published table is the smallest
that can be peeled by itself, so it holds all its digests.

Two versions are compared by their tables alone: the larger one is folded to
the smaller one's level (the halves of each third are added), the cells are
subtracted, and peeling cells that hold a single digest recovers the digests
that differ.  If peeling fails, both are built again on a higher level, from
the digests that their own tables give.

All tables of an Arrow batch lie in one array and are peeled together.
"""

from __future__ import annotations

import base64
import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PASS_BYTES, mix, passes, prefix_sums, span_hashes, stored, texts

#: Cells that a table has for each digest, at least, and beyond that.
ROOM, SPARE = 1.5, 6
#: A line is cut after a word whose hash is a multiple of this.
WORDS = 8
#: Bytes of text that one vectorised pass looks at, its edited texts beside them.
PASS = PASS_BYTES
#: Rounds of peeling after which cells that are left count as garbled.
ROUNDS = 64
_CELL = np.dtype([("count", "<i4"), ("digest", "<u8"), ("check", "<u4")])
_SALTS = np.array([[0xC2B2AE3D27D4EB4F], [0x165667B19E3779F9], [0x27D4EB2F165667C5]], np.uint64)


def digests_of(bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, digest): the distinct paragraph digests of each text, by text; the n-th of equal ones counts as its own."""
    raw = [t.encode("utf-8", "surrogatepass") for t in bodies]
    data = np.frombuffer(b"\n".join(raw), np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    blank = (data == 32) | (data >= 9) & (data <= 13)
    edge = np.diff(np.concatenate(([0], (~blank).astype(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(begin, start, side="right") - 1
    # a text of blanks alone has one digest, which its length gives
    bare = np.setdiff1d(np.flatnonzero([bool(t) for t in bodies]), owner)
    who, own = bare, np.array([len(bodies[i]) + 1 for i in bare], np.uint64)
    if len(start):
        sums = prefix_sums(data)
        word = span_hashes(data, start, end, sums)
        line = np.searchsorted(np.flatnonzero(data == 10), start)
        last = np.append(line[1:] != line[:-1], True) | (word % np.uint64(WORDS) == 0)
        head, stop = np.append(0, np.flatnonzero(last)[:-1] + 1), np.flatnonzero(last)
        body, doc = span_hashes(data, start[head], end[stop], sums), owner[head]
        order = np.lexsort((body, doc))
        body, doc = body[order], doc[order]
        fresh = np.append(True, (body[1:] != body[:-1]) | (doc[1:] != doc[:-1]))
        nth = np.arange(len(body)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        with np.errstate(over="ignore"):
            body = mix(body + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        who, own = np.concatenate((who, doc)), np.concatenate((own, body))
    order = np.lexsort((own, who))
    who, own = who[order], own[order]
    fresh = np.append(True, (own[1:] != own[:-1]) | (who[1:] != who[:-1]))[:len(own)]
    return who[fresh], own[fresh]


def _hashes(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The three hashes of each digest that give its places, and its check value."""
    with np.errstate(over="ignore"):
        h = mix(own[None, :] ^ _SALTS)
        return h, (mix(h[0] + np.uint64(0xA24BAED4963EE407)) >> np.uint64(32)).astype(np.uint32)


class Tables(NamedTuple):
    """Tables in one array: the cells, where each table begins, and its level."""

    count: np.ndarray
    digest: np.ndarray
    check: np.ndarray
    begin: np.ndarray
    level: np.ndarray


def _places(begin, level, row, h) -> np.ndarray:
    third = np.int64(1) << level[row]
    return begin[row] + np.arange(3)[:, None] * third + (h & (third - 1).astype(np.uint64)).astype(np.int64)


def build(row: np.ndarray, own: np.ndarray, sign: np.ndarray, level: np.ndarray) -> Tables:
    """A table per level given: the digests of each row added, or taken away where the sign is negative."""
    begin = np.concatenate(([0], np.cumsum(np.int64(3) << level)))
    n = int(begin[-1])
    out = Tables(np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint32), begin, level)
    if len(own):
        h, check = _hashes(own)
        at = _places(begin, level, row, h).ravel()
        out.count[:] = np.bincount(at, np.tile(sign, 3), n).astype(np.int64)
        order = np.argsort(at)
        at = at[order]
        head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        who = order % len(own)
        out.digest[at[head]] = np.bitwise_xor.reduceat(own[who], head)
        out.check[at[head]] = np.bitwise_xor.reduceat(check[who], head)
    return out


def peel(t: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(table, digest, sign) of the digests recovered, and which tables were peeled to the end; ``t`` is used up."""
    found = []
    look = np.flatnonzero(t.count)
    for _ in range(ROUNDS):
        look = look[np.abs(t.count[look]) == 1]
        h, check = _hashes(t.digest[look])
        pure = check == t.check[look]
        look, h, check = look[pure], h[:, pure], check[pure]
        if not len(look):
            break
        row = np.searchsorted(t.begin, look, side="right") - 1
        own = t.digest[look]
        order = np.lexsort((own, row))
        first = order[np.append(True, (own[order][1:] != own[order][:-1]) | (row[order][1:] != row[order][:-1]))]
        row, own, sign, h, check = row[first], own[first], t.count[look[first]], h[:, first], check[first]
        at = _places(t.begin, t.level, row, h).ravel()
        np.subtract.at(t.count, at, np.tile(sign, 3))
        np.bitwise_xor.at(t.digest, at, np.tile(own, 3))
        np.bitwise_xor.at(t.check, at, np.tile(check, 3))
        found.append((row, own, sign))
        look = np.unique(at)
    left = np.flatnonzero((t.count != 0) | (t.digest != 0) | (t.check != 0))
    done = np.ones(len(t.level), bool)
    done[np.searchsorted(t.begin, left, side="right") - 1] = False
    row, own, sign = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))
    return row, own, sign, done


class Sets(NamedTuple):
    """Digest sets in one array, and the level on which each one's own table can be peeled."""

    own: np.ndarray
    upto: np.ndarray
    level: np.ndarray

    def size(self, i: np.ndarray) -> np.ndarray:
        return self.upto[i + 1] - self.upto[i]

    def gather(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``i``, digest) of the sets ``i``."""
        size = self.size(i)
        row = np.repeat(np.arange(len(i)), size)
        return row, self.own[np.repeat(self.upto[i] - np.cumsum(size) + size, size) + np.arange(size.sum())]


def sets_of(who: np.ndarray, own: np.ndarray, n: int) -> Sets:
    size = np.bincount(who, minlength=n)
    level = np.ceil(np.log2((ROOM * size + SPARE) / 3)).astype(np.int64)
    out = Sets(own, np.concatenate(([0], np.cumsum(size))), level)
    todo = np.arange(n)
    while len(todo):
        row, d = out.gather(todo)
        done = peel(build(row, d, np.ones(len(d), np.int64), level[todo]))[3]
        todo = todo[~done]
        level[todo] += 1  # a larger table
    return out


def likenesses(s: Sets, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared digests by all digests of the sets ``a`` and ``b``, pair by pair; two sets without any are alike."""
    out = np.ones(len(a))
    low, high = np.minimum(s.level[a], s.level[b]), np.maximum(s.level[a], s.level[b])
    level, todo = low.copy(), np.arange(len(a))
    while len(todo):
        ra, da = s.gather(a[todo])
        rb, db = s.gather(b[todo])
        sign = np.concatenate((np.ones(len(da), np.int64), -np.ones(len(db), np.int64)))
        row, _, sign, done = peel(build(np.concatenate((ra, rb)), np.concatenate((da, db)), sign, level[todo]))
        only_a, only_b = (np.bincount(row[sign == k], minlength=len(todo)) for k in (1, -1))
        shared = s.size(a[todo]) - only_a
        done &= shared == s.size(b[todo]) - only_b
        every = shared + only_a + only_b
        out[todo[done]] = np.where(every[done] > 0, shared[done] / np.maximum(every[done], 1), 1.0)
        todo = todo[~done]
        level[todo] = np.maximum(level[todo] + 1, high[todo])
    return out


def published(s: Sets, i: np.ndarray) -> list[str]:
    """Number of digests, level and cells of the own tables of the sets ``i``."""
    row, d = s.gather(i)
    t = build(row, d, np.ones(len(d), np.int64), s.level[i])
    cells = np.empty(len(t.count), _CELL)
    cells["count"], cells["digest"], cells["check"] = t.count, t.digest, t.check
    raw, width = cells.tobytes(), _CELL.itemsize
    return [f"{n}:{k}:{base64.b64encode(raw[a * width:b * width]).decode()}"
            for n, k, a, b in zip(s.size(i).tolist(), s.level[i].tolist(), t.begin[:-1].tolist(), t.begin[1:].tolist())]


def opened(fingerprint: str) -> tuple[int, Tables]:
    n, level, cells = fingerprint.split(":")
    c = np.frombuffer(base64.b64decode(cells), _CELL)
    return int(n), Tables(c["count"].astype(np.int64), c["digest"].copy(), c["check"].copy(), np.array([0, len(c)]), np.array([int(level)]))


def folded(t: Tables, level: int) -> Tables:
    """One table on a lower level: the places keep their low bits."""
    shape = (3, -1, 1 << level)
    count, digest, check = t.count.reshape(shape).sum(1), np.bitwise_xor.reduce(t.digest.reshape(shape), 1), np.bitwise_xor.reduce(t.check.reshape(shape), 1)
    return Tables(count.ravel(), digest.ravel(), check.ravel(), np.array([0, 3 << level]), np.array([level]))


def compare(a: str, b: str) -> float:
    """Likeness of two published fingerprints, from nothing else."""
    (na, ta), (nb, tb) = opened(a), opened(b)
    level = int(min(ta.level[0], tb.level[0]))
    fa, fb = folded(ta, level), folded(tb, level)
    _, _, sign, done = peel(Tables(fa.count - fb.count, fa.digest ^ fb.digest, fa.check ^ fb.check, fa.begin, fa.level))
    only_a, only_b = int((sign == 1).sum()), int((sign == -1).sum())
    if done[0] and na - only_a == nb - only_b:
        return (na - only_a) / (na + only_b) if na + only_b else 1.0
    sets = [np.sort(peel(t)[1]) for t in (ta, tb)]  # the own tables give all digests
    who = np.repeat([0, 1], [na, nb])
    return float(likenesses(sets_of(who, np.concatenate(sets), 2), np.array([0]), np.array([1]))[0])


def edited(text: str, following: str) -> str:
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _rows(ids: list, pool: list[str], own: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    """Output rows of the texts ``own`` of a pool, each followed by the text ``after``."""
    new = [edited(pool[i], pool[j]) for i, j in zip(own, after)]
    s = sets_of(*digests_of(pool + new), len(pool) + len(new))
    changed = len(pool) + np.arange(len(new))
    cols = [pa.array(ids, pa.int64()), pa.array([len(pool[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
            pa.array(published(s, own), pa.string()), pa.array(published(s, changed), pa.string()),
            pa.array(likenesses(s, own, changed), pa.float64()), pa.array(likenesses(s, own, after), pa.float64())]
    return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _OUT.split(", ")])


def _parts(d: DataFrame, n: int) -> DataFrame:
    """``d`` with ``part``: numbers in the order of the rows (descending id, no id last, then the text's hash).

    Ids are cut at their quantiles.  An id that several quantiles fall on has a
    part of its own, which the hash cuts further, so a much repeated id is spread.
    """
    from pyspark.ml.feature import Bucketizer

    shares = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    cuts = [float(c) for c in d.agg(F.percentile_approx("doc_id", shares, F.lit(20 * n))).first()[0] or []]
    # an id that a double holds exactly
    often = {c: cuts.count(c) for c in set(cuts) if cuts.count(c) > 1 and abs(c) < 2**53}
    splits = [-float("inf"), *sorted({0.0, *cuts, *(float(np.nextafter(c, np.inf)) for c in often)}), float("inf")]
    b = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(d.withColumn("place", F.coalesce("doc_id", F.lit(0)).cast("double")))
    b = b.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(len(splits))).otherwise(F.lit(len(splits) - 1) - F.col("bucket")).cast("long"))
    finer = F.lit(0).cast("long")
    for c, times in often.items():
        share = (F.col("h").cast("double") + 2.0**63) / 2.0**64
        finer = F.when(F.col("place") == c, F.least(F.floor(share * times), F.lit(times - 1)).cast("long")).otherwise(finer)
    return b.withColumn("part", F.col("bucket") * (2 * n) + finer).drop("place", "bucket")


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each row's text and of its edited text, and their likenesses.

    The next document is the one after in descending doc_id; rows without an id
    come last, rows of one id by their text's hash, and after the last comes the
    first.  A table of one row is its own next.  Null texts are empty.  Rows that
    repeat follow one another.  Ids beyond 2**53 that are one double lie in one part.

    The texts are dealt out once, by ranges of the order that are known
    beforehand; within a range the next row is at hand.  Only the last row of
    each range and the first of the following one are fetched by another scan,
    and joined as many rows as there are ranges.
    """
    spark = docs.sparkSession
    n = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = _parts(d.withColumn("h", F.xxhash64("text")), n)
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.coalesce("doc_id", F.lit(0).cast("long"))).alias("down"), F.col("h").alias("h"))

    def run(batches):
        before = None  # (id, text) of the last row of its part so far
        part = None
        for batch in batches:
            ids, bodies, nums = (c.to_pylist() for c in (batch.column("doc_id"), batch.column("text"), batch.column("part")))
            for a, b in passes(bodies, most=PASS):
                keep = [] if before is None else [before]
                rows = keep + list(zip(ids[a:b], bodies[a:b]))
                of = np.array(([part] if keep else []) + nums[a:b])
                own = np.flatnonzero(of[1:] == of[:-1])
                if len(own):
                    yield _rows([rows[i][0] for i in own], [t for _, t in rows], own, own + 1)
                before, part = rows[-1], nums[b - 1]

    dealt = d.repartition(n, "part").sortWithinPartitions("part", F.col("doc_id").desc_nulls_last(), "h", "text")
    inner = dealt.select("doc_id", "text", "part").mapInArrow(run, _OUT)

    # a row per range: only their numbers and hashes meet in the window
    ends = d.groupBy("part").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    ring = ends.withColumns({"after": F.lead("first").over(Window.orderBy("part")), "least": F.min("first").over(Window.partitionBy(F.lit(0)))})
    ring = stored(ring.select("last", F.coalesce("after", "least").alias("after")), "ring")
    wanted = ring.select(F.explode(F.array("last", "after")).alias("key")).distinct()
    fetched = d.withColumn("key", place).join(F.broadcast(wanted), "key")  # two rows a range
    fetched = stored(fetched.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.min("text").alias("least"), F.max("text").alias("most")), "edges")
    one = ring.join(fetched.select(F.col("key").alias("last"), "doc_id", F.col("most").alias("text")), "last")
    one = one.join(fetched.select(F.col("key").alias("after"), F.col("least").alias("following")), "after").select("doc_id", "text", "following")

    def close(batches):
        for batch in batches:
            ids, bodies, following = (c.to_pylist() for c in batch.columns)
            for a, b in passes(bodies, most=PASS):
                m = b - a
                yield _rows(ids[a:b], bodies[a:b] + following[a:b], np.arange(m), m + np.arange(m))

    return inner.unionAll(one.mapInArrow(close, _OUT))
