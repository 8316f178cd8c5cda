import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import licenses as L


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=9))
def test_increasing_is_longest(values):
    got = [values[i] for i in L.increasing(values)]
    best = max((len(c) for r in range(len(values) + 1) for c in itertools.combinations(values, r) if all(x < y for x, y in zip(c, c[1:]))), default=0)
    assert len(got) == best and all(x < y for x, y in zip(got, got[1:]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=12), st.lists(st.sampled_from("abcdef"), max_size=12))
def test_patience_pairs_equal_words_in_order(a, b):
    got = L.patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(x < y and v < w for (x, v), (y, w) in zip(got, got[1:]))
    assert L.patience(a, a) == [(i, i) for i in range(len(a))]
    if len(set(a)) == len(a) and len(set(b)) == len(b):  # all words are anchors: as long as any common subsequence
        best = max(len(c) for r in range(len(a) + 1) for c in itertools.combinations(a, r) if is_in(c, b))
        assert len(got) == best


def is_in(c, b):
    it = iter(b)
    return all(x in it for x in c)


def test_scan(documents):
    rng = random.Random(1)
    noise = lambda n: " ".join("".join(rng.choices("abcd", k=5)) for _ in range(n))
    mit = L.TEMPLATES["mit"]
    docs = [(i, f"{noise(20)}\n{t}\n{noise(20)}") for i, t in enumerate(L.TEMPLATES.values())]
    docs += [(100, mit.upper().replace("HEREBY ", "")), (101, noise(400)), (102, None), (103, ""), (None, "ALL rights, reserved"),
             (104, "İ all rights reserved. " * 2 + noise(30000)), (105, "the of under license the of"), (100, mit)]
    got = L.scan(documents(docs)).collect()
    found = {(r.doc_id, r.template) for r in got}
    assert all((i, n) in found for i, n in enumerate(L.TEMPLATES)) and {(100, "mit"), (None, "all-rights-reserved")} <= found
    assert not {101, 102, 103, 105} & {r.doc_id for r in got}
    assert sum(r.doc_id == 104 for r in got) == 2 and sum((r.doc_id, r.template) == (100, "mit") for r in got) == 2
    text = dict(docs[:11])
    for r in got:
        if r.doc_id in text and r.template == list(L.TEMPLATES)[r.doc_id]:
            assert text[r.doc_id][r.start:r.end].lower() == L.TEMPLATES[r.template].rstrip(".").lower() and r.coverage == 1.0


def test_windows_miss_nothing_that_the_whole_text_has(documents):
    rng = random.Random(4)
    scanner = L.Scanner({"t": "alpha beta gamma delta epsilon zeta"})
    own = scanner.words[0]
    for _ in range(300):
        body = rng.choices(["x", "y", *own], k=rng.randint(0, 25))
        if rng.random() < .5:
            cut = list(own)
            cut.pop(rng.randrange(6))
            body[5:5] = cut
        want = any(len(L.patience(own, body[i:i + int(L.STRETCH * 6) + 1])) >= 5 for i in range(len(body)) if body[i] in own)
        assert bool(scanner.scan(" ".join(body))) == want


def test_empty_table(documents):
    assert L.scan(documents([])).collect() == []


def test_the_best_of_overlapping_windows(documents):
    gpl = L.TEMPLATES["gpl-notice"]
    text = f"the one two three four five six seven {gpl} and more"
    got = [r for r in L.scan(documents([(1, text)])).collect() if r.template == "gpl-notice"]
    assert [(r.coverage, text[r.start:r.end]) for r in got] == [(1.0, gpl.rstrip("."))]


def test_the_body_of_a_license_without_its_opening(documents):
    whole = L.TEMPLATES["mit-text"]
    body = whole[whole.index("THE SOFTWARE IS PROVIDED"):]
    got = L.scan(documents([(1, f"x y z\n{body}\nz y x"), (2, whole.replace("copies", "copy"))])).collect()
    assert {(r.doc_id, r.template) for r in got} >= {(1, "mit-warranty"), (2, "mit-text"), (2, "mit"), (2, "mit-warranty")}


def longest_first(own, words, need, width):
    """The rule written plainly: every window of every start, alignments by ``lcs`` of words that are unique in both."""
    def found(s):
        window = own[s:s + width]
        at = [(words.index(w), s + j) for j, w in enumerate(window) if w in words]
        best = max(([p for p in c] for r in range(len(at) + 1) for c in itertools.combinations(at, r)
                    if all(a[0] < b[0] for a, b in zip(c, c[1:]))), key=len, default=[])
        return (len(best), best[0][1], best[-1][1]) if len(best) >= need else None

    out, s = [], 0
    while s < len(own):
        one = own[s] in words and found(s)
        if not one:
            s += 1
            continue
        rivals = [m for t in range(s, one[2] + 1) if own[t] in words and (m := found(t)) and m[1] <= one[2]]
        best = max(rivals, key=lambda m: (m[0], m[1] - m[2]))  # the first of equals
        out.append(best)
        s = best[2] + 1
    return out


def test_query_equals_brute_force(documents):
    rng = random.Random(8)
    template = "alpha beta gamma delta epsilon"
    own, docs, want = template.split(), [], []
    for i in range(120):
        body = []
        # template words are unique within a window here, so the longest alignment is the only one
        while len(body) < 40:
            part = list(own)
            if rng.random() < .6:
                part.pop(rng.randrange(5))
            body += [w for p in part for w in ([p, "x"] if rng.random() < .15 else [p])] + ["y"] * rng.randint(8, 10)
        docs.append((i, " ".join(body)))
        want += [(i, n / 5, a, b) for n, a, b in longest_first(body, own, 4, int(L.STRETCH * 5) + 1)]
    got = []
    for r in L.scan(documents(docs), {"t": template}).collect():
        text = dict(docs)[r.doc_id]
        got.append((r.doc_id, r.coverage, text[:r.start].count(" "), text[:r.end].count(" ")))
    assert sorted(got) == sorted(want) and len(got) > 100
