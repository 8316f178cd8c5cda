import math
import random

import numpy as np

from sluice.llm import quality as Q
from sluice.llm import toxicity as T
from sluice.llm.labelled import training_ids


def corpus(n=240):
    rng, docs, labels = random.Random(2), [], []
    word = lambda: "".join(rng.choices("abcdeilnorst", k=rng.randint(2, 8)))
    for d in range(n):
        body = [word() for _ in range(rng.randint(5, 80))]
        bad, toxic = d % 3 == 0, d % 4 == 0
        if toxic:
            body[len(body) // 2:] = ["grumph", rng.choice(["ziffix", "ziffolo", "zifferu"])] + body[len(body) // 2:]
        docs.append((d, (" | " if bad else " ").join(body)))
        labels.append((d, int(not bad), int(toxic)))
    return docs, labels


def tables(spark, documents, more=()):
    docs, labels = corpus()
    odd = [(900, None), (901, ""), (None, "plain words"), (902, "ok " * 50000), (3, docs[3][1])]
    df = spark.createDataFrame(labels + list(more), "doc_id long, quality int, toxic int").selectExpr("*", "'t' as text")
    return documents(docs + odd), df, dict((d, (q, t)) for d, q, t in labels)


def accuracy(rows, want, which):
    held = [r for r in rows if r.held_out and r.doc_id in want]
    assert len(held) > 20
    return np.mean([r.predicted == want[r.doc_id][which] for r in held])


def test_quality_on_held_out_rows(spark, documents, folded):
    docs, labels, want = tables(spark, documents, [(None, 1, 1), (5, None, None), (6, 0, 0)])
    rows = Q.scored(docs, Q.fit(docs, labels)).collect()
    assert len(rows) == 245 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and folded(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    assert accuracy(rows, want, 0) > 0.95
    assert len({r.score for r in rows if r.doc_id == 3}) == 1


def test_votes_equal_brute_force():
    docs, labels = corpus(60)
    rows = [Q.terms(t) for _, t in docs[:40]]
    space = Q.Space(rows, np.array([q for _, q, _ in labels[:40]]), 8)
    vectors = space.embed([t for _, t in docs])
    for i, s in enumerate(space.score([t for _, t in docs], 5)):
        cos = [float(vectors[i] @ space.vectors[j]) for j in range(40)]
        near = sorted(range(40), key=lambda j: -cos[j])[:5]
        w = {j: max(cos[j], 1e-6) * space.share[j] for j in near}
        assert math.isclose(s, sum(w[j] * space.label[j] for j in near) / sum(w.values()), abs_tol=1e-4)


def test_labels_of_the_held_out_fold_are_not_read(spark, documents, folded):
    docs, labels, _ = tables(spark, documents)
    got = training_ids(labels, "quality", 5, 0, 30).collect()
    assert all(folded(r.doc_id, 5) for r in got) and max(sum(r.label == c for r in got) for c in (0, 1)) <= 30
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    a, b = (sorted(map(str, Q.scored(docs, Q.fit(docs, x)).collect())) for x in (labels, flipped))
    assert a == b


def test_toxicity_on_held_out_rows(spark, documents, folded):
    docs, labels, want = tables(spark, documents, [(None, 1, 1), (5, None, None)])
    lexicon = T.fit(docs, labels)
    assert " grumph " in lexicon.weights
    rows = T.scored(docs, lexicon).collect()
    assert len(rows) == 245 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and folded(r.doc_id, 4) == 2) and r.predicted == int(r.score >= 0.3) for r in rows)
    assert accuracy(rows, want, 1) == 1.0


def test_folding_and_exceptions():
    assert T.folded("Сl0wn, рl@y!\nA1so") == " clown play aiso "
    lexicon = T.Lexicon({" clown ": 3.0, " grum": 2.0}, [" clown fish "])
    assert lexicon.amount("a CL0WN") == lexicon.amount("a clown") > 0
    assert lexicon.amount("the clown fish") == 0 < lexicon.amount("clown fish clown")
    assert lexicon.amount("grumble") > 0 == lexicon.amount("xgrumble") == lexicon.amount(None) == lexicon.amount("")
    assert lexicon.amount("clown " + "x " * 2000) < lexicon.amount("clown")


def test_automaton_equals_brute_force():
    rng = random.Random(4)
    words = ["abba", "abb", "baba", "ab"]
    lexicon = T.Lexicon({" abb": 1.0, " baba ": 2.0}, [" ab baba "])
    for _ in range(200):
        own = rng.choices(words, k=rng.randint(0, 8))
        want = sum(w.startswith("abb") for w in own) + 2 * sum(
            w == "baba" and not (i and own[i - 1] == "ab") for i, w in enumerate(own))
        assert math.isclose(lexicon.amount(" ".join(own)) * (1 + math.log1p(T.folded(" ".join(own)).count(" ") / 200)), want)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for docs, n in ((documents([]), 0), (documents([(1, "a b")]), 1)):
        assert Q.scored(docs, Q.fit(docs, none)).count() == T.scored(docs, T.fit(docs, none)).count() == n
    assert [r.score for r in Q.scored(documents([(1, "a")]), None).collect()] == [0.5]


def test_good_keeps_every_column(spark, documents):
    docs, labels, want = tables(spark, documents)
    kept = Q.good(docs, Q.fit(docs, labels))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert np.mean([(d in ids) == bool(q) for d, (q, _) in want.items()]) > 0.95


def test_marks_and_format_characters_are_folded():
    from sluice.llm.toxicity import folded

    assert folded("c\u0336l\u0336own clo\u200bwn \u0441l0wn \uff23\uff2c\uff2f\uff37\uff2e clo\u00adwn") == " clown clown clown clown clown "
    assert folded("Sch\u00d6n scho\u0308n") == " sch\u00f6n sch\u00f6n " and folded(None) == "  "
