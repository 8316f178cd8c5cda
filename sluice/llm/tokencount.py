"""Token counts that follow edits.

A text is cut into pre-tokens by the tokenizer's pattern; runs of ``LEAF``
pre-tokens are the leaves of a segment tree whose nodes hold the characters
and tokens below them.  An edit re-encodes the leaves it touches, with two
characters of context to the left (the pattern looks no further ahead than
one character behind a match) and on to the right until a new cut
falls on an old leaf's start: from there the cuts are the same, because a match
depends only on what follows it.  Then only the sums above those leaves change.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import from_json
from .common import passes, texts

LEAF = 16
#: A leaf that has grown beyond this many pre-tokens makes its tree be built anew.
FULL = 4 * LEAF
#: New pre-tokens up to which the tokenizer itself is asked.
FEW = 24
#: Pre-tokens whose counts a worker keeps.
KEPT = 500_000
# Fixed value: the pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Counter:
    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.merges = from_json(path)
        self.one = Tokenizer.from_file(path)
        self.one.encode_special_tokens = True
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def cuts(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def learn(self, texts: list[str | None]) -> None:
        """Count the pre-tokens of many texts together, so that each text finds its own known."""
        seen = set()
        for t in texts:
            seen.update(self.cuts(t or ""))
        if len(seen) <= KEPT:
            self.counts(list(seen))

    def counts(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        new = list(set(pieces).difference(self.known))
        if new:
            if len(self.known) + len(new) > KEPT:
                self.known, new = {}, list(set(pieces))
            if len(new) <= FEW:  # a pass over few words costs more than they do
                for p in new:
                    self.known[p] = len(self.one.encode(p, add_special_tokens=False).ids)
                return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
            raw = [p.encode("utf-8", "replace") for p in new]
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            _, begin = self.merges.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size)
            self.known.update(zip(new, np.diff(begin).tolist()))
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


class Tree:
    """Sums over leaves: node i has children 2i and 2i+1, the leaves are the last half."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.width = 1 << max(0, int(len(chars) - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width:self.width + len(chars), 0] = chars
        self.sums[self.width:self.width + len(chars), 1] = tokens
        at = self.width
        while at > 1:
            self.sums[at // 2:at] = self.sums[at:2 * at:2] + self.sums[at + 1:2 * at:2]
            at //= 2

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, or the last with any, and where it begins)."""
        node, begin = 1, 0
        at = min(at, max(0, self.chars - 1))
        while node < self.width:
            left = int(self.sums[2 * node, 0])
            node, at, begin = (2 * node, at, begin) if at < left else (2 * node + 1, at - left, begin + left)
        return node - self.width, begin

    def set(self, first: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        lo = self.width + first
        hi = lo + len(chars)
        self.sums[lo:hi, 0], self.sums[lo:hi, 1] = chars, tokens
        while lo > 1:
            lo, hi = lo // 2, (hi - 1) // 2 + 1
            self.sums[lo:hi] = self.sums[2 * lo:2 * hi:2] + self.sums[2 * lo + 1:2 * hi:2]


def _leaves(sizes: np.ndarray, counts: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    upto = np.concatenate(([0], np.cumsum(sizes))), np.concatenate(([0], np.cumsum(counts)))
    return np.diff(upto[0][cuts]), np.diff(upto[1][cuts])


def build(text: str, count: Counter) -> Tree:
    pieces = count.cuts(text)
    cuts = np.append(np.arange(0, len(pieces), LEAF), len(pieces)) if pieces else np.zeros(2, np.int64)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return Tree(*_leaves(sizes, count.counts(pieces), cuts))


def apply(tree: Tree, text: str, start: int, end: int, insert: str, count: Counter) -> tuple[Tree, str, int]:
    """The tree and text after text[start:end] became ``insert``, and how many characters were encoded again."""
    new = text[:start] + insert + text[end:]
    if not tree.chars:
        return build(new, count), new, len(new)
    shift = len(new) - len(text)
    first, begin = tree.leaf(max(0, start - 2))
    last, at = first, begin  # leaves first .. last - 1 are replaced; ``at`` is where leaf ``last`` begins
    pieces, here, over = [], begin, False
    for m in count.pattern.finditer(new, begin):
        old = here - shift
        while last < tree.width and at < old:
            at += int(tree.sums[tree.width + last, 0])
            last += 1
        if here >= start + len(insert) and at == old and last > first and at < tree.chars:
            over = True
            break
        pieces.append(m[0])
        here = m.end()
    if not over:
        last = tree.width
    slots = last - first
    if len(pieces) > slots * FULL or not slots:
        return build(new, count), new, len(new)
    cuts = np.linspace(0, len(pieces), slots + 1).astype(np.int64) if len(pieces) > slots * LEAF else np.minimum(
        np.arange(slots + 1) * LEAF, len(pieces))
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    tree.set(first, *_leaves(sizes, count.counts(pieces), cuts))
    return tree, new, int(sizes.sum())


def recount(docs: DataFrame, edits: str, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, edited_tokens, edited_chars, encoded_again) per document row.

    ``edits`` is a column of ``docs``: array<struct<start:int,end:int,insert:string>>
    of code-point offsets, applied in order, each to what the one before left;
    offsets beyond the text mean its end, a null insert is empty, null edits are
    none.  Null and empty texts have no tokens.
    """
    def run(batches):
        count = counter(tokenizer_path)
        for batch in batches:
            keys, bodies, changes = (c.to_pylist() for c in batch.columns)
            rows = []
            for a, b in passes(bodies):
                count.learn(bodies[a:b])
                for key, text, own in zip(keys[a:b], bodies[a:b], changes[a:b]):
                    text = text or ""
                    tree = build(text, count)
                    before, again = tree.tokens, 0
                    for e in own or []:
                        start = min(max(0, e["start"] or 0), len(text))
                        end = min(max(start, e["end"] or 0), len(text))
                        tree, text, n = apply(tree, text, start, end, e["insert"] or "", count)
                        again += n
                    rows.append((key, before, tree.tokens, len(text), again))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[
                "doc_id", "n_tokens", "edited_tokens", "edited_chars", "encoded_again"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(edits).alias("edits"))
    return d.mapInArrow(run, "doc_id long, n_tokens long, edited_tokens long, edited_chars long, encoded_again long")


def with_edits(docs: DataFrame) -> DataFrame:
    """Three edits a document: a replaced middle, a cut near the front, an addition at the end."""
    n = F.length("text")
    edit = lambda a, b, s: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"), s.alias("insert"))
    return texts(docs).withColumn("edits", F.array(
        edit(n / 2, n / 2 + 20, F.reverse(F.substring("text", 1, 24))), edit(n / 5, n / 5 + 9, F.lit("")),
        edit(n + 24, n + 24, F.lit(" it's done 42"))))
