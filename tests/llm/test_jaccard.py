import random
import re

import pytest

from sluice.llm import jaccard as J
from sluice.llm.graph import components, with_links


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(docs, k, t):
    sets = [shingles(x, k) for _, x in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((str(d), len(sets[i]), str(min(ids) if ids else None)))
    return sorted(out)


def corpus(seed, n, chain=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijk", k=rng.randint(2, 6)))
    docs = []
    while len(docs) < n:
        base = [word() for _ in range(rng.choice([2, 3, 8, 15, 40, 120, 300]))]
        for _ in range(rng.choice([1, 1, 2, 5, 25])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, len(own) // 20])):
                at = rng.randrange(len(own) or 1)
                own[at:at + 1] = rng.choice([[word()], [], [*own[at:at + 1], word()]])
            docs.append((len(docs) * 3 + 1, rng.choice([" ", "\n", "  "]).join(own).title() if rng.random() < .2 else " ".join(own)))
    walk = [word() for _ in range(60)]
    for i in range(chain):  # each is near the one before, not the first
        walk[i % 60] = word()
        docs.append((9000 - i, " ".join(walk)))
    rng.shuffle(docs)
    return docs + [(7000, None), (7001, ""), (7002, " \n\t"), (7003, "one"), (7004, "ONE"), (7005, "É one"), (7006, "é one"),
                   (7007, docs[0][1]), (7008, docs[0][1]), (docs[3][0], docs[3][1])]


@pytest.mark.parametrize("k,t,seed", [(3, 90, 1), (5, 80, 2)])
def test_groups_equal_brute_force(documents, k, t, seed):
    docs = corpus(seed, 140, chain=25)
    got = J.groups(documents(docs).repartition(4), k, t).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(docs, k, t)


def test_rows_without_an_id(documents):
    docs = [(None, "a b c d e f"), (5, "a b c d e f"), (None, "z y x w"), (None, "z y x w"), (None, None)]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.groups(documents(docs)).collect())
    assert got == [("5", 4, "5"), ("None", 0, "None"), ("None", 2, "None"), ("None", 2, "None"), ("None", 4, "5")]


def test_large_near_copy_group_makes_few_pairs(documents, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(400)]
    docs = []
    for d in range(300):
        own = list(base)
        own[rng.randrange(400)] = f"x{d}"
        docs.append((d, " ".join(own)))
    made = []
    real = J._linked
    monkeypatch.setattr(J, "_linked", lambda pairs, parts, t: made.append(pairs.count()) or real(pairs, parts, t))
    assert {r.component_id for r in J.groups(documents(docs)).collect()} == {0}
    assert sum(made) < 5 * len(docs)


def test_long_texts(documents):
    rng = random.Random(9)
    base = [f"v{rng.randrange(10**6)}" for _ in range(40000)]
    docs = [(1, " ".join(base)), (2, " ".join(base[:39000])), (3, " ".join(base[:30000])), (4, " ".join(base[:2100])),
            (5, " ".join(base[:2000])), (6, " ".join(base[:1500]))]
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.groups(documents(docs)).collect()) == brute(docs, 3, 90)


def test_one_of_each(documents):
    docs = corpus(4, 120)
    df = documents(docs)
    kept = J.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({c for d, _, c in brute(docs, 5, 80)})


def test_one_of_each_where_ids_clash(documents):
    first, other = [" ".join(f"{w}{i}" for i in range(40)) for w in "ab"]
    # 2 is a near copy of 1 and a text of its own; 3 has one text twice; 4 has two texts without n-grams
    docs = [(1, first), (2, first + " end"), (2, other), (3, other + " end"), (3, other + " end"), (4, "x"), (4, "y"), (4, "y")]
    for parts in (1, 5):
        kept = J.one_of_each(documents(docs).repartition(parts)).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == [(1, first), (2, other), (4, "x"), (4, "y")]


def test_empty_table(documents):
    assert J.groups(documents([])).collect() == []
    assert J.one_of_each(documents([])).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 300), (7, 7), (500, 500), (900, 800)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 200: 100, 300: 100, 900: 800, 800: 800}


def test_links_added_to_components(spark):
    frame = lambda rows: spark.createDataFrame(rows, "u long, v long")
    roots = components(frame([(1, 2), (2, 3), (10, 11), (20, 21)]))
    got = {r.node: r.root for r in with_links(roots, frame([(3, 10), (11, 2), (30, 31), (31, 32), (1, 3), (40, 40)])).collect()}
    sets = {}
    for node, root in got.items():
        sets.setdefault(root, set()).add(node)
    assert sorted(map(sorted, sets.values())) == [[1, 2, 3, 10, 11], [20, 21], [30, 31, 32], [40]]


def test_shared_keys_equal_plain_counts_whatever_the_batches(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(40) if rng.random() < 0.7 else 77, rng.randrange(25), 1) for _ in range(900)] + [(1000 + i, i, 1) for i in range(50)]
    want = {}
    for key, node in {(k, n) for k, n, _ in rows}:
        if len({n for k, n, _ in rows if k == key}) > 1:
            want[node] = want.get(node, 0) + 1
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for size in ("1", "2", "7", "10000"):
            spark.conf.set(name, size)
            got = J.shared_keys(spark.createDataFrame(rows, "key long, node long, need int")).groupBy("node").count().collect()
            assert {r.node: r["count"] for r in got} == want
    finally:
        spark.conf.set(name, before)
