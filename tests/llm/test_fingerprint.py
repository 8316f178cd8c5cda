import hashlib
import random

import numpy as np
import pytest

from sluice.llm import fingerprint as P


def sets(bodies):
    """Digest sets of texts, as Python sets."""
    who, own = P.digests_of(bodies)
    return [set(own[who == i].tolist()) for i in range(len(bodies))]


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 6)))
    docs = [(i * 7, "\n".join(" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 12)))) for i in range(90)]
    return docs + [(1000, None), (1001, ""), (1002, " \n"), (None, "no id"), (None, None), (1003, "long " * 40000), (7, docs[1][1]),
                   (-5, "x"), (2**60, "far"), (2**60 + 1, "further")]


def plain(docs):
    rows = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for (i, t), (_, f) in zip(rows, rows[1:] + rows[:1]):
        n = len(t) // 3
        e = t[:len(t) - n] + f[:n]
        a, b, c = sets([t, e, f])
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), like(a, b), like(a, c)))
    return want


@pytest.mark.parametrize("parts", [1, 4, 200])
def test_rows_equal_brute_force(documents, parts):
    docs = [r for r in corpus() if r[0] is not None]
    got = P.fingerprints(documents(docs), parts).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got) == sorted(plain(docs))
    # the likenesses follow from the published columns alone
    by_id = {r.doc_id: r for r in got}
    order = sorted(by_id, reverse=True)
    for i, j in zip(order, order[1:] + order[:1]):
        assert P.compare(by_id[i].fingerprint, by_id[i].edited_fingerprint) == by_id[i].near_edited
        if 7 not in (i, j):  # 7 is there twice
            assert P.compare(by_id[i].fingerprint, by_id[j].fingerprint) == by_id[i].near_next


def test_rows_without_an_id_come_last(documents):
    got = P.fingerprints(documents(corpus()), 5).collect()
    assert len(got) == len(corpus()) and sorted(r.n_chars for r in got if r.doc_id is None) == [0, 5]
    docs = [(None, "b b b b"), (3, "a a a"), (1, "c c c c c c")]
    got = {r.doc_id: r.edited_sha256 for r in P.fingerprints(documents(docs), 3).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {3: sha("a a c"), 1: sha("c c c c b b"), None: sha("b b ba ")}


def test_a_much_repeated_id_is_spread(documents):
    docs = [(5, f"{i} is a text of one id") for i in range(300)] + [(i, f"{i} other") for i in range(400, 460)]
    df = documents(docs)
    from pyspark.sql import functions as F
    d = P._parts(df.select("doc_id", "text").withColumn("h", F.xxhash64("text")), 12)
    assert d.where("doc_id = 5").select("part").distinct().count() > 4
    got = P.fingerprints(df, 12).collect()
    assert len(got) == 360 and sum(r.doc_id == 5 for r in got) == 300
    # each text of the repeated id is followed by another one, but for the last
    assert len({r.edited_sha256 for r in got}) == 360


@pytest.mark.parametrize("extra", [0, 1, 5, 40, 300])
def test_peeling_recovers_the_difference(extra):
    rng = np.random.default_rng(extra)
    both = rng.integers(1, 2**63, 200).astype(np.uint64)
    a = np.unique(np.concatenate((both, rng.integers(1, 2**63, extra).astype(np.uint64))))
    b = np.unique(np.concatenate((both, rng.integers(1, 2**63, extra // 2).astype(np.uint64))))
    row = np.zeros(len(a) + len(b), np.int64)
    sign = np.repeat([1, -1], [len(a), len(b)])
    for level in range(1, 12):
        _, own, got, done = P.peel(P.build(row, np.concatenate((a, b)), sign, np.array([level])))
        if done[0]:
            assert set(own[got == 1].tolist()) == set(a.tolist()) - set(b.tolist())
            assert set(own[got == -1].tolist()) == set(b.tolist()) - set(a.tolist())
        else:
            assert 3 << level < 4 * extra + 12  # too few cells
    s = P.sets_of(np.repeat([0, 1], [len(a), len(b)]), np.concatenate((a, b)), 2)
    want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert P.likenesses(s, np.array([0, 1, 0]), np.array([1, 0, 0])).tolist() == [want, want, 1.0]
    fa, fb = P.published(s, np.array([0, 1]))
    assert P.compare(fa, fb) == want and P.compare(fa, fa) == 1.0


def test_folding_equals_building_small():
    own = np.random.default_rng(2).integers(1, 2**63, 50).astype(np.uint64)
    make = lambda k: P.build(np.zeros(50, np.int64), own, np.ones(50, np.int64), np.array([k]))
    for small in range(6):
        assert all((x == y).all() for x, y in zip(P.folded(make(6), small), make(small)))


def test_equal_texts_and_small_edits():
    text = " ".join(f"word{i}" for i in range(400))
    near, far = text.replace("word77", "x"), " ".join(f"other{i}" for i in range(400))
    pool = [text, str(text), near, far, "", "", " \n", "a b\n" * 3, "a b"]
    s = P.sets_of(*P.digests_of(pool), len(pool))
    like = lambda i, j: P.likenesses(s, np.array([i]), np.array([j]))[0]
    fp = P.published(s, np.arange(len(pool)))
    assert fp[0] == fp[1] and like(0, 1) == 1.0 and like(0, 2) > 0.9 > 0.1 > like(0, 3)
    assert fp[4] == fp[5] and like(4, 5) == 1.0 and like(4, 6) == 0.0 and like(0, 4) == 0.0
    assert s.size(np.array([7]))[0] == 3 * s.size(np.array([8]))[0]  # the n-th of equal paragraphs counts


def test_empty_and_single(documents):
    assert P.fingerprints(documents([])).collect() == []
    (r,) = P.fingerprints(documents([(1, "abcdef")])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert [r.near_next for r in P.fingerprints(documents([(None, None)])).collect()] == [1.0]
