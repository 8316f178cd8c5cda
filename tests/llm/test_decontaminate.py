import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import decontaminate as D


def brute(item: bytes, body: bytes) -> int:
    """Fewest edits of the item against any substring."""
    row = [0] * (len(body) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(body, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=120, deadline=None)
@given(st.text("abc ", min_size=1, max_size=14), st.text("abc ", max_size=30), st.integers(0, 4))
def test_align_equals_full_table(item, body, k):
    item, body = item.encode(), body.encode()
    want = brute(item, body)
    got = D.align(item, body, k, 0, len(body))
    assert (got[0] if got else None) == (want if want <= k else None)
    if got:
        assert brute(item, body[got[1]:got[2]]) == got[0]


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "q", "zz"[:1] + text[at]]) + text[at + 1:]
    return text


def cases():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 40)))) for i in range(12)] + [(50, "tiny bit"), (51, ""), (52, None)]
    docs = []
    for d in range(36):
        body = " ".join(word() for _ in range(rng.randint(0, 120)))
        if d % 2:
            i, t = items[d % 12]
            body += "\n " + edited(rng, t.upper() if d % 4 == 1 else t, d % 9) + "  " + word()
        docs.append((d, body))
    return items, docs + [(100, None), (101, ""), (102, "so TINY\n bit"), (3, docs[3][1]), (None, items[0][1]), (104, "x" * 200000 + items[1][1])]


def test_matches_equal_brute_force(spark, documents):
    items, docs = cases()
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "7 as doc_id")
    got = sorted((str(r.doc_id), r.item_id, r.edits) for r in D.matches(documents(docs).repartition(3), bench).collect())
    want = []
    for d, t in docs:
        for i, x in items:
            item, body = D.normal(x), D.normal(t)
            if item and (e := 0 if item in body else brute(item, body) if len(body) < 5000 else 99) <= D.edit_budget(len(item)):
                want.append((str(d), i, e))
    assert got == sorted(want) and len(want) > 10


def test_blocks_of_the_query_set_do_not_change_the_result(spark, documents):
    items, docs = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole, cut = D.matches(documents(docs), bench), D.matches(documents(docs), bench, block_bytes=300)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_clean_keeps_the_rest(spark, documents):
    items, docs = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(docs)
    bad = {(r.doc_id) for r in D.matches(df, bench).collect()}
    kept = D.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in bad)


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(documents([(1, "a")]), bench).collect() == []
    assert D.clean(documents([(1, "a")]), bench).count() == 1
    assert D.matches(documents([]), spark.createDataFrame([(1, "some text here")], "item_id long, text string")).collect() == []
