"""Spelling variants: words one edit apart, joined by asymmetric q-chunks.

One edit of a word leaves one of any two disjoint chunks of it as they are, and
moves it by one place at most.  So of two words the shorter (or either, if they
are as long) enters its two chunks, the halves, and the other enters its
positional grams of the chunks' lengths, each under every chunk place that lies
within one shift.  Words that share an entry are verified by their distance.

A chunk that more than ``hot`` words share is cut further, not across: what is
left of both words beside the chunk differs by one edit, so the entry is
extended by the rest with one code point left out.  Pairs that share such a
longer entry are nearly all true ones, so no group makes all its pairs.

A word's form is its most frequent near word if that is ``factor`` times as
frequent; forms are followed to the last by pointer jumping.

Defined results: null and empty texts have no words; a null id is written as the
empty string; rows that repeat count again; an empty table gives no words.  Ties
of form go to the smallest word in code-point order.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts

# Fixed value: the letters of a run.
LETTERS = "A-Za-zÀ-ÿ"
#: A run whose hash this divides loses a code point.
NOISE = 199
#: Least code points and occurrences of a word.
LENGTH, TIMES = 6, 5
#: Times a form must be as frequent.
FACTOR = 5
#: Words that share a chunk before their entries are extended.
HOT = 64
#: Distinct words that a task keeps before it hands their counts on.
KEPT = 200_000


def runs(doc_id: int | None, text: str, noise: int, length: int) -> Counter:
    """Occurrences of the words of a text that have ``length`` code points at least."""
    found = Counter(re.findall(f"[{LETTERS}]{{{length},}}", text.encode("utf-8", "replace").lower().decode()))  # bytes: A-Z only
    begin, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), begin)
        if h % noise == 0:
            run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) < length:
                continue
        out[run] += n
    return out


def words(docs: DataFrame, noise: int = NOISE, length: int = LENGTH, times: int = TIMES) -> DataFrame:
    """(word, n) of the words with ``times`` occurrences at least; counts are summed within a task before they are shuffled."""

    def run(batches):
        kept: Counter = Counter()

        def handed_on():
            return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text:
                    kept.update(runs(doc_id, text, noise, length))
                    if len(kept) >= KEPT:
                        yield handed_on()
                        kept.clear()
        yield handed_on()

    return (texts(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= times))


def _left_out(rest: str, mark: str = "''") -> str:
    """SQL: ``rest`` with each code point left out in turn, each behind ``mark``."""
    return f"transform(sequence(1, length({rest})), i -> concat({mark}, left({rest}, i - 1), substr({rest}, i + 1)))"


#: Length of the first chunk of a word of length {0}.
_HALF = "({0} div 2)"


def chunks(vocabulary: DataFrame) -> DataFrame:
    """(word, n, key, rest): the two chunks of each word and what is beside them."""
    half = _HALF.format("length(word)")
    two = F.expr(f"""array(
        named_struct('key', concat_ws(':', length(word), 1, left(word, {half})), 'rest', substr(word, {half} + 1)),
        named_struct('key', concat_ws(':', length(word), 2, substr(word, {half} + 1)), 'rest', left(word, {half})))""")
    return vocabulary.select("word", "n", F.explode(two).alias("e")).select("word", "n", "e.*")


def grams(vocabulary: DataFrame) -> DataFrame:
    """(word, n, key, rest, longer): the positional grams of each word that can be a chunk, shifted by one at most, of
    a word as long or one shorter."""
    entries = []
    for longer in (0, 1):
        size = f"(length(word) - {longer})"
        half = _HALF.format(size)
        for slot, start, length in ((1, "0", half), (2, half, f"({size} - {half})")):
            for shift in range(longer + 1):
                at = f"({start} + {shift})"
                entries.append(f"""named_struct('key', concat_ws(':', {size}, {slot}, substr(word, {at} + 1, {length})),
                    'rest', concat(left(word, {at}), substr(word, {at} + {length} + 1)), 'longer', {longer} = 1)""")
    every = F.expr(f"array_distinct(array({', '.join(entries)}))")
    return vocabulary.select("word", "n", F.explode(every).alias("e")).select("word", "n", "e.*")


def near(vocabulary: DataFrame, hot: int = HOT) -> DataFrame:
    """(u, nu, v, nv): each pair of words exactly one inserted, deleted or replaced code point apart, once."""
    short, long_ = chunks(vocabulary), grams(vocabulary)
    often = stored(short.groupBy("key").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > hot)
                   .select("key", F.lit(True).alias("often")), "often")
    replaced, mark = _left_out("rest", "concat('=', i, ':')"), "array('')"
    short = short.join(often, "key", "left").withColumn("beside", F.explode(F.expr(
        f"if(often, concat({replaced}, array(concat('+', rest))), {mark})")))
    inserted = _left_out("rest", "'+'")
    long_ = long_.join(often, "key", "left").withColumn("beside", F.explode(F.expr(
        f"if(often, if(longer, array_distinct({inserted}), {replaced}), {mark})")))
    u = short.select("key", "beside", F.col("word").alias("u"), F.col("n").alias("nu"))
    v = long_.select("key", "beside", "longer", F.col("word").alias("v"), F.col("n").alias("nv"))
    met = u.join(v, ["key", "beside"]).where("(longer or u < v) and levenshtein(u, v, 1) = 1")
    return met.select("u", "nu", "v", "nv").distinct()


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: each round every word takes its root's root, so chains halve."""
    roots = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(roots.join(ahead, "root", "left").select("word", "root", "next"), "step")
        if step.where("next is not null").isEmpty():
            return roots
        roots = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, noise: int = NOISE, length: int = LENGTH, times: int = TIMES, factor: int = FACTOR, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word."""
    if length < 2:
        raise ValueError("two chunks need words of two code points at least")
    vocabulary = stored(words(docs, noise, length, times), "words")
    pairs = stored(near(vocabulary, hot), "near")
    both = pairs.select(F.col("u").alias("word"), F.col("v").alias("other"), F.col("nv").alias("other_n")).unionAll(
        pairs.select("v", "u", "nu"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    is_form = -F.col("best.less") >= factor * F.col("n")
    forms = stored(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    return forms.join(followed(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
