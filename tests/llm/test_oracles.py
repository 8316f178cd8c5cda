import random

import duckdb
import pyarrow as pa

from sluice.llm import jaccard, oracles, repeats, variants


def duck(docs, sql):
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string())}))
    return con.execute(sql).fetchall()


def same(got, docs, sql, names):
    key = lambda r: [(x is None, str(x)) for x in r]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=key) == sorted(duck(docs, sql), key=key)


def odd(rng):
    vocabulary = ["Éclair", "eclair", "eclairs", "straße", "straßen", "strase", "lorem", "ipsum", "DOLOR", "dolores", "x y", "a\tb", "😀", "ñandú", "nandu"]
    common = " ".join(rng.choices(vocabulary, k=60))
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(40)]
    docs += [(50 + i, common + " " + "é" * i) for i in range(6)] + [(70, None), (71, ""), (72, " \n"), (73, "ONE two"), (74, "one TWO"), (None, common), (50, common)]
    return docs + [(80, "abcé" * 200), (81, "x" + "abcé" * 200), (81, "x" * 199), (82, "x" * 200), (83, "y" * 201)]


def test_sql_of_repeats(documents):
    docs = odd(random.Random(5))
    same(repeats.without_repeats(documents(docs)), docs, oracles.repeats(), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def test_sql_of_near_groups(documents):
    docs = odd(random.Random(6))
    for words, t in ((3, 90), (5, 80)):
        same(jaccard.groups(documents(docs), words, t), docs, oracles.near_groups(words, t), ["doc_id", "n_shingles", "component_id"])


def test_sql_of_variants(documents):
    docs = odd(random.Random(7))
    for noise, length, times in ((199, 6, 5), (3, 4, 1)):
        same(variants.variants(documents(docs), noise, length, times), docs, oracles.variants(noise, length, times),
             ["word", "form", "root", "n", "n_near", "form_n"])
