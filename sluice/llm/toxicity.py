"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters and digits that stand
for letters, format characters (zero width, soft hyphen) and marks that compose
with no letter left out, everything else a blank.  Composed letters keep their
marks, which tell words of many languages apart.  The lexicon (words and word beginnings)
and the exception phrases are learnt from a bounded labelled sample; entries
carry log-odds weights, and the sum over a text is divided by a measure of its
length before a logistic curve fitted on the same sample turns it into a score.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, texts
from .labelled import training_texts

PER_CLASS = 6000
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
SHORTEST, LONGEST = 4, 10
#: Entries the lexicon may have, and pairs of words kept as exceptions.
ENTRIES, EXCEPTIONS = 2000, 2000

# Letters that look like the Latin letter below them, and digits or signs that stand for letters.
_LOOKS = dict(zip("авеіјкмнорсԁуѕтхαεικνορτυχɡ",
                  "abeijkmhopcdystxaeikvoptuxg"))
_SIGNS = dict(zip("013457@$", "oieastas"))
#: Categories of marks that stand by themselves and of format characters.
_LEFT_OUT = ("Mn", "Me", "Cf")


class _Fold(dict):
    """Translation table that works out a letter when it first meets it."""

    def __missing__(self, code: int):
        c = unicodedata.normalize("NFKC", chr(code).lower())
        c = "".join(x for x in c if unicodedata.category(x) not in _LEFT_OUT)
        out = "".join(_LOOKS.get(x, _SIGNS.get(x, x if x.isalpha() else " ")) for x in c)
        self[code] = out
        return out


_FOLD = _Fold()


def folded(text: str | None) -> str:
    """Folded words between single blanks, with a blank at either end."""
    return f" {' '.join(unicodedata.normalize('NFC', text or '').translate(_FOLD).split())} "


def features(words: set[str]) -> set[str]:
    """Word beginnings (" begin") and whole words (" word ") of a text's words."""
    out = set()
    for w in words:
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in range(SHORTEST, min(len(w), LONGEST) + 1))
    return out


def _counts(sample: DataFrame, wanted=None) -> DataFrame:
    """(feature, toxic, clean): number of sample texts that have it, added up in each task first."""
    held = None if wanted is None else sample.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        both = (Counter(), Counter())
        for batch in batches:
            for t, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                if held is None:
                    both[label].update(features(set(folded(t).split())))
                else:
                    own = folded(t).split()
                    both[label].update({f" {a} {b} " for a, b in zip(own, own[1:])
                                        if any(f" {w} " in held.value or any(f" {w[:n]}" in held.value for n in range(SHORTEST, LONGEST + 1)) for w in (a, b))})
            if len(both[0]) + len(both[1]) > 500_000:
                yield _rows(both)
                both = (Counter(), Counter())
        yield _rows(both)

    raw = sample.mapInArrow(run, "feature string, toxic long, clean long")
    return raw.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _rows(both):
    keys = list(both[0].keys() | both[1].keys())
    return pa.RecordBatch.from_arrays([
        pa.array(keys, pa.string()), pa.array([both[1][k] for k in keys], pa.int64()),
        pa.array([both[0][k] for k in keys], pa.int64())], names=["feature", "toxic", "clean"])


def closed(found: dict[str, tuple[int, int]]) -> dict[str, tuple[int, int]]:
    """Drop an entry whose texts a longer one has nearly all of, and one that a shorter kept one covers."""
    keep = dict(found)
    for f, (t, _) in found.items():
        longer = [g for g in found if g != f and g.startswith(f)]
        if not f.endswith(" ") and any(found[g][0] >= 0.9 * t for g in longer):
            keep.pop(f, None)
    return {f: v for f, v in keep.items() if not any(f != g and f.startswith(g) for g in keep)}


class Lexicon:
    def __init__(self, weights: dict[str, float], exceptions: list[str] = ()):
        self.weights, self.exceptions = weights, list(exceptions)
        self.curve = (-3.0, 1.0)
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for w, x in self.weights.items():
                self._automaton.add_word(w, (len(w), x))
            for w in self.exceptions:
                self._automaton.add_word(w, (len(w), None))
            self._automaton.make_automaton()
        return self._automaton

    def amount(self, text: str | None) -> float:
        """Weights of the entries matched outside exception phrases, by the length of the text."""
        if not self.weights:
            return 0.0
        t = folded(text)
        hits, spared = [], []
        for end, (n, weight) in self.automaton.iter(t):
            (spared if weight is None else hits).append((end - n + 1, end, weight))
        total = sum(w for a, b, w in hits if not any(x <= a and b <= y for x, y, _ in spared))
        return total / (1 + math.log1p(t.count(" ") / 200))

    def score(self, text: str | None) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * self.amount(text)))))

    def calibrate(self, amounts: np.ndarray, label: np.ndarray) -> None:
        """Logistic curve by Newton steps with a small ridge."""
        x = np.stack([np.ones(len(amounts)), amounts], 1)
        w = np.zeros(2)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
            w -= np.clip(np.linalg.solve(h, x.T @ (p - label) + 0.01 * w), -3, 3)
        self.curve = (float(w[0]), max(0.0, float(w[1])))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, exceptions: list[str] = ()) -> Lexicon:
    """Learn entries, exceptions and curve; ``exceptions`` adds phrases of the caller's own."""
    sample = training_texts(docs, labels, "toxic", FOLDS, HELD, per_class)
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    own = [folded(e) for e in exceptions]
    if not n_toxic or not n_clean:
        return Lexicon({}, own)
    share = n_toxic / (n_toxic + n_clean)
    odds = F.log((F.col("toxic") + 0.1) / (F.col("clean") + 0.5)) - math.log(n_toxic / n_clean)
    total = F.col("toxic") + F.col("clean")
    part = F.col("toxic") / total
    # likelihood ratio against the sample's share of toxic texts; many features are tried, so the bar is high
    gain = 2 * (F.col("toxic") * F.log(part / share)
                + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - part) / (1 - share))).otherwise(0.0))
    best = (_counts(sample).where((F.col("toxic") >= 4) & (part >= share + 0.75 * (1 - share)))
            .withColumns({"odds": odds, "gain": gain}).where("gain >= 20 and odds > 2")
            .orderBy(F.desc("gain"), "feature").limit(ENTRIES).collect())
    found = closed({r["feature"]: (r["toxic"], r["clean"]) for r in best})
    weights = {r["feature"]: r["odds"] for r in best if r["feature"] in found}
    pairs = (_counts(sample, set(weights)).where((F.col("clean") >= 4) & (F.col("clean") > 4 * F.col("toxic")))
             .orderBy(F.desc("clean"), "feature").limit(EXCEPTIONS).collect()) if weights else []
    lexicon = Lexicon(weights, own + [r["feature"] for r in pairs])
    model = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                pa.array([model.value.amount(t) for t in batch.column("text").to_pylist()], pa.float64()),
                batch.column("label").cast(pa.int32())], names=["amount", "label"])

    got = sample.mapInArrow(run, "amount double, label int").collect()
    lexicon.calibrate(np.array([r["amount"] for r in got]), np.array([r["label"] for r in got], float))
    return lexicon


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row; null and empty texts hold no entry, a null id is not held out."""
    model = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for batch in batches:
            ids, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            s = np.array([model.value.score(t) for t in bodies], np.float64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([fold(i, FOLDS) == HELD for i in ids], pa.bool_()), pa.array(s, pa.float64()),
                pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return texts(docs).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
