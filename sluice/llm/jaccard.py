"""Similarity join of word n-gram sets by vertical partitioning.

The global order of n-grams is that of their hashes; it is cut into fragments.
Two sets of a similarity of t differ in at most D n-grams, D following from
their sizes, so of F > D fragments at least F - D are the same in both.  A coarse cut
(F little above D) finds the sets that share enough fragments with any other;
only these are cut again finely (F = 4 D), and two linked ones must share a
fragment among the D + 1 rarest of each and have parity maps at most D apart.  For these candidates the overlap is
counted fragment by fragment, in separate rows, and summed per pair.

Copies (equal sets) are one node.  Within a group that shares a fragment not
all pairs are made: members are first compared with the one that has most in common with the rest, then only
members of different components with ever more of them, until the group is
one component or all its remaining pairs have been compared.  So no link that
joins components is lost, and a large group of near copies costs about as
many pairs as it has members.

An n-gram, and a set, is identified by a 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, mix, passes, span_hashes, stored, texts
from .graph import components, with_links

#: Sizes at which the overlap of a pair is counted in more fragments, and how many.
LEVELS = ((1, 4), (2048, 16), (32768, 256))
#: Members of a group that all are compared with one another as soon as one hub does not join them.
SMALL_GROUP = 16
#: 64-bit words of the parity map of a set: two maps differ in at most as many bits as the sets in n-grams.
MAP_WORDS = 8
_MAP = [f"m{i}" for i in range(MAP_WORDS)]
_RATIO = 1.5


def _bounds() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * _RATIO)))
    return np.array(out, np.int64)


_BOUNDS = _bounds()


def differing(size_class: np.ndarray, t: int) -> np.ndarray:
    """Most n-grams in which two linked sets of a size class differ (t in percent)."""
    return (100 - t) * 2 * (_BOUNDS[size_class + 1] - 1) // (100 + t)


def fragments(size_class: np.ndarray, t: int, fine: bool = False) -> np.ndarray:
    d = differing(size_class, t)
    return 4 * d + 1 if fine else d + 1 + (d + 3) // 4


def gram_sets(bodies: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, n-gram hash) of the distinct n-grams, sorted by both."""
    raw = b"\n".join([(t or "").encode("utf-8", "replace") for t in bodies])
    data = np.frombuffer(raw, np.uint8).copy()
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    begin = np.concatenate(([0], np.cumsum([len((t or "").encode("utf-8", "replace")) + 1 for t in bodies])))
    inside = ~((data == 32) | (data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(begin, start, side="right") - 1
    word = span_hashes(data, start, end)
    count = np.bincount(doc, minlength=len(bodies))
    with np.errstate(over="ignore"):
        grams, owners = [], []
        if len(word) >= words:
            acc = np.zeros(len(word) - words + 1, np.uint64)
            for i in range(words):
                acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + word[i:len(word) - words + 1 + i] + np.uint64(i + 1))
            whole = doc[:len(acc)] == doc[words - 1:]
            grams.append(acc[whole])
            owners.append(doc[:len(acc)][whole])
        few = np.flatnonzero((count > 0) & (count < words))
        first = np.searchsorted(doc, few)
        for f, d in zip(first, few):
            acc = np.full(1, count[d], np.uint64)
            for i in range(count[d]):
                acc = mix(acc * np.uint64(0xD6E8FEB86659FD93) + word[f + i] + np.uint64(77))
            grams.append(acc)
            owners.append(np.array([d]))
    if not grams:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    g, o = np.concatenate(grams), np.concatenate(owners)
    order = np.lexsort((g, o))
    g, o = g[order], o[order]
    fresh = np.concatenate(([True], (g[1:] != g[:-1]) | (o[1:] != o[:-1])))
    return o[fresh], g[fresh]


def fragment_keys(doc: np.ndarray, gram: np.ndarray, size: np.ndarray, t: int, fine: bool = False):
    """Look-up keys of the sets: a list of (document, size class, cut, key, fragments needed in common).

    A set is entered under its own size class and, if it can be linked to larger
    sets of the next one, under that too.  If so many of its fragments are empty
    that the equal ones might all be empty, another order (another hash) is used
    beside the first.  Both sets of a linked pair that needs it do so.
    """
    own = np.searchsorted(_BOUNDS, size, side="right") - 1
    beyond = np.searchsorted(_BOUNDS, size * 100 // t, side="right") - 1
    out = []
    for step in (0, 1):
        kind = own + step
        most = differing(np.maximum(kind, 0), t)
        total = fragments(np.maximum(kind, 0), t, fine)
        todo = (size > 0) & (kind <= beyond) & (most > 0)
        scheme = 0
        while todo.any():
            pick = todo[doc]
            d = doc[pick]
            g = gram[pick] if scheme == 0 else mix(gram[pick] ^ np.uint64(0xA0761D6478BD642F * scheme & (2**64 - 1)))
            part = ((g >> np.uint64(33)) * total[d].astype(np.uint64) >> np.uint64(31)).astype(np.int64)
            if scheme:
                order = np.lexsort((part, d))
                d, g, part = d[order], g[order], part[order]
            head = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (part[1:] != part[:-1]))))
            with np.errstate(over="ignore"):
                body = np.add.reduceat(mix(g + np.uint64(0x51ED270B)), head)
                place = (kind[d[head]].astype(np.uint64) << np.uint64(48)) + (np.uint64(scheme) << np.uint64(40)) + part[head].astype(np.uint64)
                key = mix(body + mix(place + np.uint64(1 + fine)))
            filled = np.bincount(d[head], minlength=len(size))
            out.append((d[head], kind, np.full(len(size), scheme), key, np.maximum(1, filled - most)))
            todo = todo & (filled <= most)
            scheme += 1
    return out


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, its hash and a number that finds the row again (ids may be null)."""
    return texts(docs).withColumn("body", F.xxhash64("text")).withColumn("row", F.coalesce("doc_id", "body"))


def set_nodes(doc: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
    """Hash of each document's set (0 for an empty one)."""
    out = np.zeros(n, np.uint64)
    if len(doc):
        head = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        with np.errstate(over="ignore"):
            out[doc[head]] = mix(np.add.reduceat(mix(gram ^ np.uint64(0x8EBC6AF09C88C6E3)), head))
    return out.view(np.int64)


def parity_maps(doc: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
    """Bit i of a set's map tells whether it has an odd number of n-grams that fall on i."""
    bits = 64 * MAP_WORDS
    out = np.zeros((n, bits), np.uint8)
    cell, count = np.unique(doc * bits + (gram >> np.uint64(20)).astype(np.int64) % bits, return_counts=True)
    out.flat[cell] = count & 1
    return np.packbits(out, axis=1).view(">i8").astype(np.int64)


def measured(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, body, row, n, node) per document row."""
    def run(batch):
        bodies = batch.column("text").to_pylist()
        for a, b in passes(bodies):
            doc, gram = gram_sets(bodies[a:b], words)
            size = np.bincount(doc, minlength=b - a)
            yield {**{c: batch.column(c)[a:b] for c in ("doc_id", "body", "row")}, "n": pa.array(size.astype(np.int64)),
                   "node": pa.array(set_nodes(doc, gram, b - a))}

    return map_batches(_rows(docs), run, "doc_id long, body long, row long, n long, node long")


def coarse_keys(docs: DataFrame, words: int, t: int) -> DataFrame:
    """(key, node, need): ``need`` keys of a set at least are in another set if it is linked; sets of a pass enter once."""
    def run(batch):
        bodies = batch.column("text").to_pylist()
        for a, b in passes(bodies):
            doc, gram = gram_sets(bodies[a:b], words)
            node = set_nodes(doc, gram, b - a)
            _, first = np.unique(node, return_index=True)
            take = np.zeros(b - a, bool)
            take[first] = True
            doc, gram = doc[take[doc]], gram[take[doc]]
            found = fragment_keys(doc, gram, np.bincount(doc, minlength=b - a), t)
            need = np.full(b - a, 1 << 30)
            for owner, _, _, _, least in found:
                has = np.unique(owner)
                need[has] = np.minimum(need[has], least[has])
            for owner, _, _, key, _ in found:
                yield {"key": pa.array(key.view(np.int64)), "node": pa.array(node[owner]), "need": pa.array(need[owner].astype(np.int32))}

    return map_batches(docs.select(F.col("text").cast("string").alias("text")), run, "key long, node long, need int")


def shared_keys(keys: DataFrame) -> DataFrame:
    """(node, need) for every key of a set that another set has too.

    The keys are shuffled once and sorted; a scan hands on the sets of each key that has several, whatever their
    number, and holds one row back.
    """
    def run(batches):
        last = None  # (key, node, need) of the last row; whether it has been handed on
        sent = False
        for batch in batches:
            key, node, need = (batch.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            old = last is not None
            if old:
                key, node, need = (np.append(v, x) for v, x in zip(last, (key, node, need)))
            fresh = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))  # a set once a key
            at = np.flatnonzero(fresh)
            k = key[at]
            with_next = np.append(k[1:] == k[:-1], False)
            with_last = np.append(False, with_next[:-1])
            several = with_next | with_last
            give = several.copy()
            if old and sent:
                give[0] = False
            give = at[give]
            # the last row may have its like in the next batch
            same_as_first = len(at) == 1 and old
            sent = bool(several[-1]) or (same_as_first and sent)
            last = (key[-1], node[-1], need[-1])
            yield pa.RecordBatch.from_arrays([pa.array(node[give]), pa.array(need[give])], names=["node", "need"])

    dealt = keys.repartition("key").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(run, "node long, need int")


def fine_keys(bodies: DataFrame, words: int, t: int) -> DataFrame:
    """(node, n, cut, deep, total, keys, parity map): a row per set, size class and order; the ``deep`` rarest keys decide."""
    def run(batch):
        bodies = batch.column("text").to_pylist()
        for a, b in passes(bodies):
            doc, gram = gram_sets(bodies[a:b], words)
            size, node, maps = np.bincount(doc, minlength=b - a), set_nodes(doc, gram, b - a), parity_maps(doc, gram, b - a)
            for owner, kind, scheme, key, _ in fragment_keys(doc, gram, size, t, fine=True):
                has, count = np.unique(owner, return_counts=True)
                at = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
                yield {"node": pa.array(node[has]), "n": pa.array(size[has].astype(np.int64)),
                       "cut": pa.array((kind[has] * 256 + scheme[has]).astype(np.int32)),
                       "deep": pa.array(differing(kind[has], t) + 1), "total": pa.array(count.astype(np.int64)),
                       "keys": pa.ListArray.from_arrays(pa.array(at), pa.array(key.view(np.int64))),
                       **{c: pa.array(maps[has, i]) for i, c in enumerate(_MAP)}}

    return map_batches(bodies, run, "node long, n long, cut int, deep long, total long, keys array<long>, "
                       + ", ".join(f"{c} long" for c in _MAP))


def _level(n):
    out = F.lit(len(LEVELS) - 1)
    for i in range(len(LEVELS) - 1, 0, -1):
        out = F.when(n < LEVELS[i][0], i - 1).otherwise(out)
    return out


def set_fragments(bodies: DataFrame, words: int, t: int) -> DataFrame:
    """(node, level, fragment, grams) of each text's set, a row per fragment."""
    def run(batch):
        bodies = batch.column("text").to_pylist()
        for a, b in passes(bodies):
            doc, gram = gram_sets(bodies[a:b], words)
            size, node = np.bincount(doc, minlength=b - a), set_nodes(doc, gram, b - a)
            for level, (least, cuts) in enumerate(LEVELS):
                most = LEVELS[level + 1][0] if level + 1 < len(LEVELS) else 1 << 62
                pick = (size >= least) & (size * t // 100 < most)  # also one that a smaller set of this level may meet
                take = pick[doc]
                d, g = doc[take], gram[take]
                part = ((g >> np.uint64(33)) * np.uint64(cuts) >> np.uint64(31)).astype(np.int64)
                head = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (part[1:] != part[:-1])))) if len(d) else np.empty(0, np.int64)
                at = np.concatenate((head, [len(d)])).astype(np.int32)
                yield {"node": pa.array(node[d[head]]), "level": pa.array(np.full(len(head), level, np.int32)),
                       "fragment": pa.array(part[head].astype(np.int32)),
                       "grams": pa.ListArray.from_arrays(pa.array(at), pa.array(g.view(np.int64)))}

    return map_batches(bodies, run, "node long, level int, fragment int, grams array<long>")


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """``pairs(u, nu, v, nv)`` with their overlap: counted per fragment, then summed."""
    p = pairs.withColumn("level", _level(F.least("nu", "nv")))
    left = parts.select(F.col("node").alias("u"), "level", "fragment", F.col("grams").alias("gu"))
    right = parts.select(F.col("node").alias("v"), "level", "fragment", F.col("grams").alias("gv"))
    partial = (p.join(left, ["u", "level"]).join(right, ["v", "level", "fragment"])
               .select("u", "nu", "v", "nv", F.size(F.array_intersect("gu", "gv")).alias("shared")))
    return partial.groupBy("u", "nu", "v", "nv").agg(F.sum("shared").alias("shared"))


def _linked(pairs: DataFrame, parts: DataFrame, t: int) -> DataFrame:
    return overlaps(pairs, parts).where(F.expr(f"100 * shared >= {t} * (nu + nv - shared)")).select("u", "v")


def _pairs(members: DataFrame, hubs: DataFrame, t: int, extra=None) -> DataFrame:
    """Distinct (u < v) of a hub and a member of one group, of sizes that allow a link."""
    apart = " + ".join(f"bit_count({c} ^ hub_{c})" for c in _MAP)  # no more than the n-grams in which they differ
    m = members.join(hubs, "key").where("node <> hub")
    m = m.where(F.expr(f"100 * least(n, hub_n) >= {t} * greatest(n, hub_n)"))
    m = m.where(F.expr(f"{100 + t} * ({apart}) <= {100 - t} * (n + hub_n)"))
    if extra is not None:
        m = m.where(extra)
    first = F.col("node") < F.col("hub")
    return m.select(F.least("node", "hub").alias("u"), F.when(first, F.col("n")).otherwise(F.col("hub_n")).alias("nu"),
                    F.greatest("node", "hub").alias("v"), F.when(first, F.col("hub_n")).otherwise(F.col("n")).alias("nv")).distinct()


def groups(docs: DataFrame, words: int = 3, t: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document row.

    ``t`` is the least similarity in percent.  Null, empty and blank texts have
    no n-grams and are linked with nothing.  Rows that share an id are separate
    rows; a row without an id takes the smallest id of its component, if any
    has one.  Component ids are the smallest id reachable by links.
    """
    return _grouped(docs, words, t).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _grouped(docs: DataFrame, words: int, t: int) -> DataFrame:
    """(doc_id, body, n, root, component_id) per document row; ``root`` tells components apart where ids clash."""
    s = stored(measured(docs, words), "sets")
    common = shared_keys(coarse_keys(docs, words, t)).groupBy("node").agg(F.count(F.lit(1)).alias("common"), F.min("need").alias("need"))
    near = stored(common.where("common >= need").select("node"), "near")
    nodes = s.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"), F.min("row").alias("row"))
    # stored first: where the rows are few they are broadcast, and no text is shuffled
    rows = stored(nodes.join(near, "node").select("row").distinct(), "near-rows")
    # a text per set; rows may share an id, so the sets are told apart again by their hash
    bodies = stored(_rows(docs).join(rows, "row", "left_semi").select("text"), "bodies")
    parts = stored(set_fragments(bodies, words, t).dropDuplicates(["node", "level", "fragment"]), "parts")

    fine = stored(fine_keys(bodies, words, t).dropDuplicates(["node", "cut"]), "fine")
    keys = fine.select("node", "cut", F.explode("keys").alias("key"))
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    of_set = Window.partitionBy("node", "cut")
    ranked = (keys.join(often, "key").withColumns({
        "rank": F.row_number().over(of_set.orderBy("often", "key")), "found": F.count(F.lit(1)).over(of_set),
        "score": F.sum("often").over(of_set)}))
    # keys that no other set has come first in the order: they are total - found
    members = ranked.join(fine.drop("keys"), ["node", "cut"]).where("rank + total - found <= deep")
    members = stored(members.select("key", "node", "n", "score", *_MAP), "members")

    top = F.max(F.struct("score", F.col("node").alias("hub"), F.col("n").alias("hub_n"), *[F.col(c).alias(f"hub_{c}") for c in _MAP]))
    hubs = members.groupBy("key").agg(top.alias("h")).select("key", "h.hub", "h.hub_n", *[f"h.hub_{c}" for c in _MAP])
    tested = stored(_pairs(members, hubs, t), "pairs")
    links = stored(_linked(tested, parts, t), "links")
    roots = components(links)
    wide, open_, most = SMALL_GROUP, None, 0
    while True:
        if open_ is None:  # the components have changed
            now = members.join(roots, "node", "left").select("key", "node", "n", *_MAP, F.coalesce("root", "node").alias("root"))
            split = now.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size"))
            open_ = stored(now.join(split.where("lo <> hi").select("key", "size"), "key"), "open")
            most = open_.agg(F.max("size")).first()[0]
        if most is None:
            break
        # a member is a hub if its hash falls in the share wide / size of all hashes
        chance = (F.xxhash64("node", F.lit("hub")).cast("double") + 2.0**63) / 2.0**64 * F.col("size")
        hubs = open_.where((F.col("size") <= wide) | (chance < wide)).select(
            "key", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("root").alias("hub_root"), *[F.col(c).alias(f"hub_{c}") for c in _MAP])
        new = _pairs(open_, hubs, t, F.col("root") != F.col("hub_root")).join(tested.select("u", "v"), ["u", "v"], "left_anti")
        new = stored(new, "pairs")
        if not new.isEmpty():
            tested = tested.unionAll(new.select(tested.columns))
            links = stored(_linked(new, parts, t), "links")
            if not links.isEmpty():
                roots, open_ = with_links(roots, links), None
        if wide >= most:  # every pair of different components that share a fragment has been compared
            break
        wide *= 64
    named = nodes.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select("node", "root", "component_id")
    out = s.select("doc_id", "body", "n", "node").join(named, "node", "left")
    return out.select("doc_id", "body", "n", "root",
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, t: int = 80) -> DataFrame:
    """The document rows (all columns) that stand for their group: the one with its smallest id.

    Rows are told apart by id and text: where an id has several texts, each
    component keeps one row, by smallest id, then by the text's hash.  Of rows that
    repeat both one stays.  Texts without n-grams are components of their own.
    Rows without an id cannot stand for a group and are kept as they are.
    """
    g = stored(_grouped(docs.where("doc_id is not null"), words, t).select("doc_id", "body", "n", "root"), "grouped")
    first = g.where("n > 0").groupBy("root").agg(F.min(F.struct("doc_id", "body")).alias("first")).select("first.*")
    keep = first.unionByName(g.where("n = 0").select("doc_id", "body").distinct())
    # the user's row is one column, so its names meet no others
    rows = docs.where("doc_id is not null").select(F.struct(*docs.columns).alias("row")).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("row.text").cast("string")).alias("body"), "row")
    kept = rows.join(keep, (rows.doc_id == keep.doc_id) & (rows.body.eqNullSafe(keep.body)), "left_semi")
    one = kept.groupBy("doc_id", "body").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*").unionAll(docs.where("doc_id is null"))
