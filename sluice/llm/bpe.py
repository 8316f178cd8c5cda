"""Byte-pair merges of many words at once.

Words of one length form a matrix of token ids.  A pass merges, in each row,
the leftmost pair of the lowest rank, which is the order that the public
tokenizers apply; only the two pairs beside a merge are looked up again.
Vocabulary and merges come from a tokenizer file; nothing is trained here.
"""

from __future__ import annotations

import json

import numpy as np

_NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class Merges:
    """Open-addressed table from a pair of ids to the rank and id of its merge."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], first: np.ndarray, last: np.ndarray):
        self.first, self.last = first, last  # id of a byte inside a word, and at its end
        size = 1 << max(8, (len(pairs) * 16).bit_length())
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, _NONE, np.int32)
        self.ids = np.zeros(size, np.int32)
        keys = np.fromiter((a << 32 | b for a, b in pairs), np.int64, len(pairs))
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        at, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):  # each free slot goes to one of the keys that reach it, the others go one slot on
            self.probes += 1
            free = todo[self.keys[at[todo]] == -1]
            self.keys[at[free]] = keys[free]
            placed = self.keys[at[todo]] == keys[todo]
            done, todo = todo[placed], todo[~placed]
            self.ranks[at[done]], self.ids[at[done]] = values[done, 0], values[done, 1]
            at[todo] = (at[todo] + 1) % size

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key)
        hit = self.keys[at] == key
        rank, new = np.where(hit, self.ranks[at], _NONE), self.ids[at]
        open_ = ~hit & (self.keys[at] != -1)
        for _ in range(1, self.probes):
            if not open_.any():
                break
            i = np.flatnonzero(open_)
            at.flat[i] = (at.flat[i] + 1) % len(self.keys)
            found = self.keys[at.flat[i]]
            ok = found == key.flat[i]
            rank.flat[i[ok]] = self.ranks[at.flat[i[ok]]]
            new.flat[i[ok]] = self.ids[at.flat[i[ok]]]
            open_.flat[i[ok | (found == -1)]] = False
        return rank, new

    def encode(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words raw[start:start+size], end to end, and where each word's ids begin."""
        counts, blocks = np.zeros(len(start), np.int64), []
        order = np.argsort(size, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else []:
            width = int(size[own[0]])
            step = max(1, 500_000 // width)
            for at in range(0, len(own), step):
                part = own[at:at + step]
                self._merge(raw[start[part][:, None] + np.arange(width)], part, counts, blocks)
        begin = np.zeros(len(start) + 1, np.int64)
        np.cumsum(counts, out=begin[1:])
        pool = np.empty(begin[-1], np.uint32)
        for who, ids in blocks:
            pool[begin[who][:, None] + np.arange(ids.shape[1])] = ids
        return pool, begin

    def _merge(self, raw: np.ndarray, who: np.ndarray, counts: np.ndarray, blocks: list) -> None:
        ids = self.first[raw]
        ids[:, -1] = self.last[raw[:, -1]]
        rank, new = self.look(ids[:, :-1], ids[:, 1:])
        while True:
            width = ids.shape[1]
            rows = np.arange(len(who))
            best = rank.argmin(axis=1) if width > 1 else np.zeros(len(who), np.int64)
            go = rank[rows, best] != _NONE if width > 1 else np.zeros(len(who), bool)
            if not go.all():
                counts[who[~go]] = width
                blocks.append((who[~go], ids[~go]))
                who, ids, rank, new, best = who[go], ids[go], rank[go], new[go], best[go]
                rows = np.arange(len(who))
            if not len(who):
                return
            ids[rows, best] = new[rows, best]
            keep = np.ones(ids.shape, bool)
            keep[rows, best + 1] = False
            ids = ids[keep].reshape(len(who), width - 1)
            keep = np.ones(rank.shape, bool)
            keep[rows, best] = False
            rank, new = rank[keep].reshape(len(who), width - 2), new[keep].reshape(len(who), width - 2)
            for side in (-1, 0):  # the pairs (best-1, best) and (best, best+1) after the merge
                at = best + side
                ok = np.flatnonzero((at >= 0) & (at < width - 2))
                if len(ok):
                    rank[ok, at[ok]], new[ok, at[ok]] = self.look(ids[ok, at[ok]], ids[ok, at[ok] + 1])


def from_json(path: str) -> Merges:
    """Merges of a byte-level tokenizers file, with its word-end suffix if it has one."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    pairs = {}
    for rank, m in enumerate(model["merges"]):
        a, b = m if isinstance(m, list) else m.split(" ")
        pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
    letters = byte_letters()
    first = np.array([vocab.get(c, -1) for c in letters], np.int32)
    last = np.array([vocab.get(c + suffix, -1) for c in letters], np.int32)
    return Merges(pairs, first, last)
