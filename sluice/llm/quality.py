"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms of a text are trigrams of letter classes, hashed words, and how much of
it repeats.  The space and the labelled vectors come from a bounded sample
(``PER_CLASS`` labelled texts a class); every document is then compared with
all of them by exact cosine products, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import fold, span_hashes, texts
from .labelled import training_texts

PER_CLASS = 1500
DIMENSIONS = 48
NEIGHBOURS = 25
THRESHOLD = 0.3
FOLDS, HELD = 5, 0
BLOCK = 1024

_WORDS = 1024
_LEVELS = 12
_TERMS = 4096 + _WORDS + 3 * _LEVELS


def _classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        out[b] = (1 if b >= 0x80 or c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c == "\n"
                  else 5 if c.isspace() else {".": 6, ",": 7, "!": 8, "?": 9, "|": 10, "-": 11}.get(c, 12 if c in "'\"()" else 13))
    return out


_CLASS = _classes()


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and weights; an empty text has the one term that says so."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    kind = _CLASS[data].astype(np.int64)
    words = (kind != 4) & (kind != 5)
    edge = np.diff(np.concatenate(([0], words.astype(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.array([_TERMS - 1]), np.ones(1, np.float32)
    own = span_hashes(data, start, end)
    tri = np.bincount(kind[:-2] * 256 + kind[1:-1] * 16 + kind[2:], minlength=4096) if len(data) > 2 else np.zeros(4096, np.int64)
    bag = np.bincount((own >> np.uint64(54)).astype(np.int64), minlength=_WORDS)
    lines = [x for x in (text or "").split("\n") if x]
    shares = (np.mean(own[1:] == own[:-1]) if len(own) > 1 else 0.0,
              1 - len(np.unique(own)) / len(own), 1 - len(set(lines)) / max(1, len(lines)))
    extra = np.zeros(3 * _LEVELS)
    for i, s in enumerate(shares):
        extra[i * _LEVELS + min(_LEVELS - 2, int(s * (_LEVELS - 1)))] = 1
    weight = np.concatenate((np.sqrt(tri / max(1, tri.sum())), 0.5 * np.sqrt(bag / bag.sum()), 0.3 * extra))
    at = np.flatnonzero(weight)
    return at, weight[at].astype(np.float32)


class Space:
    """Inverse document frequencies, the leading right singular vectors, and the labelled vectors."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, dimensions: int = DIMENSIONS):
        x = np.zeros((len(rows), _TERMS), np.float32)
        for i, (at, w) in enumerate(rows):
            x[i, at] = w
        self.idf = (1 + np.log((1 + len(rows)) / (1 + np.count_nonzero(x, axis=0)))).astype(np.float32)
        x *= self.idf
        rng = np.random.default_rng(7)
        rank = max(1, min(dimensions, *x.shape))
        basis = x.T @ rng.standard_normal((len(rows), rank + 8), np.float32)
        for _ in range(4):  # subspace iteration
            basis, _ = np.linalg.qr(x.T @ (x @ basis))
        _, _, vt = np.linalg.svd(x @ basis, full_matrices=False)
        self.axes = np.ascontiguousarray((basis @ vt.T)[:, :rank], np.float32)
        self.vectors, self.label = self._unit(x @ self.axes), label.astype(np.float64)
        ones = self.label.sum()
        #: A vote counts for more where the sample holds fewer of its class.
        self.share = np.where(self.label == 1, 1 / max(1, ones), 1 / max(1, len(label) - ones))

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def embed(self, bodies: list[str | None]) -> np.ndarray:
        out = np.empty((len(bodies), self.axes.shape[1]), np.float32)
        for i, t in enumerate(bodies):
            at, w = terms(t)
            out[i] = (w * self.idf[at]) @ self.axes[at]
        return self._unit(out)

    def score(self, bodies: list[str | None], neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of the neighbours' similarity that labels 1 hold; ties at the last place fall to the earlier row."""
        out = np.empty(len(bodies))
        k = min(neighbours, len(self.label))
        for at in range(0, len(bodies), BLOCK):
            cosine = self.embed(bodies[at:at + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6).astype(np.float64) * self.share[near]
            out[at:at + BLOCK] = (w * self.label[near]).sum(1) / w.sum(1)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Space | None:
    """None where no labelled text is left to learn from."""
    def run(batches):
        for batch in batches:
            rows = [terms(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0].astype("<i4").tobytes() for r in rows], pa.binary()),
                pa.array([r[1].astype("<f4").tobytes() for r in rows], pa.binary()),
                batch.column("label").cast(pa.int32())], names=["at", "weight", "label"])

    sample = training_texts(docs, labels, "quality", FOLDS, HELD, per_class)
    got = sorted(sample.mapInArrow(run, "at binary, weight binary, label int").collect())
    if not got:
        return None
    rows = [(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["weight"], "<f4")) for r in got]
    return Space(rows, np.array([r["label"] for r in got]))


def scored(docs: DataFrame, space: Space | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row; without anything learnt every score is 0.5.

    Null and empty texts are scored as texts without words; a null id is not held out.
    """
    model = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches):
        for batch in batches:
            ids, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            s = model.value.score(bodies) if model.value else np.full(len(bodies), 0.5)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([fold(i, FOLDS) == HELD for i in ids], pa.bool_()), pa.array(s, pa.float64()),
                pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return texts(docs).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def good(docs: DataFrame, space: Space | None) -> DataFrame:
    """The document rows (all columns, unchanged) that score at least the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches):
        for batch in batches:
            bodies = batch.column("text").to_pylist()
            s = model.value.score(bodies) if model.value else np.full(len(bodies), 0.5)
            yield batch.filter(pa.array(s >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
