import random
import re
import zlib
from collections import Counter

import pytest

from sluice.llm import variants as V

NOISE, LENGTH, TIMES, FACTOR = 5, 6, 2, 3


def one_edit(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, noise=NOISE, length=LENGTH, times=TIMES, factor=FACTOR):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                run = "".join(c for i, c in enumerate(run) if i != h % len(run))
            if len(run) >= length:
                count[run] += 1
    n = {w: k for w, k in count.items() if k >= times}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) if near[w] else None for w in n}
    form = {w: b if (b := best[w]) is not None and n[b] >= factor * n[w] else None for w in n}
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=str)


def corpus(seed, alphabet="abé", extra=""):
    """Words that are edits of one another, their frequencies spread over several powers of the factor."""
    rng = random.Random(seed)
    base = ["".join(rng.choices(alphabet, k=rng.randrange(5, 10))) for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(30)):
            w = base[min(int(rng.expovariate(0.5)), 11)]
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", *alphabet]) + w[at + rng.randrange(2):]
            words.append(rng.choice([w, w, w.upper(), w.capitalize()]))
        rows.append((i if i % 17 else None, rng.choice([" ", "-", "\n", "1", ", "]).join(words) + extra))
    return rows + [(7, None), (8, ""), rows[3], rows[3], (9, "Straße ÀÉÎÕÜß x" * 3 + "Ānaïvely ×÷multi naïvely naivelÿ")]


@pytest.mark.parametrize("hot", [0, 1, 64])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(documents, seed, hot):
    rows = corpus(seed)
    got = V.variants(documents(rows), NOISE, LENGTH, TIMES, FACTOR, hot)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_forms_are_followed_through_chains(documents):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    rows = [(i, " ".join([w] * 3 ** k)) for k, w in enumerate(chain) for i in [k]]
    got = {r.word: r for r in V.variants(documents(rows), 10**9, LENGTH, 1, 3).collect()}
    assert {r.root for r in got.values()} == {"abbbbb"} and got["aaaaaa"].form == "aaaaab" and got["abbbbb"].form is None
    assert sorted(map(tuple, got.values()), key=str) == plain(rows, 10**9, LENGTH, 1, 3)


def test_words_that_share_a_chunk_do_not_make_all_pairs(spark):
    rng = random.Random(3)
    words = {"shared" + "".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)}
    vocabulary = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    short, long_ = V.chunks(vocabulary), V.grams(vocabulary)
    assert short.groupBy("key").count().agg({"count": "max"}).first()[0] == len(words)
    got = {tuple(sorted((r.u, r.v))) for r in V.near(vocabulary).collect()}
    by_gap = Counter((i, w[:i] + w[i + 1:]) for w in words for i in range(12))
    assert len(got) == sum(k * (k - 1) // 2 for k in by_gap.values()) and len(got) < len(words)
    assert long_.count() <= 6 * len(words)


def test_empty_tables(documents):
    assert V.variants(documents([])).collect() == [] and V.variants(documents([(1, "short on words")])).collect() == []
