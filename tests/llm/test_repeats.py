import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sluice.llm import repeats as R


def plain(docs):
    seen = Counter()
    raws = [(t or "").encode() for _, t in docs]
    for b in raws:
        seen.update(b[i:i + 200] for i in range(len(b) - 199))
    out = []
    for (d, _), b in zip(docs, raws):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:len(b)]]) if b else b""
        out.append((str(d), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed, n=60):
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choices("abcdefgh é\n\0", k=k))
    shared = [noise(k) for k in (199, 200, 201, 230, 400, 900)] + ["ab" * 300, "z" * 450]
    docs = []
    for d in range(n):
        body = noise(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 4)
            body += s[a:len(s) - rng.randint(0, len(s) // 4)] + noise(rng.randint(0, 200))
        docs.append((d, body))
    base = noise(3000)
    for d in range(8):
        at = rng.randrange(3000)
        docs.append((500 + d, base[:at] + "#" + base[at + 1:]))
    return docs + [(900, None), (901, ""), (902, "x" * 199), (903, "y" * 200), (904, "w" * 201), (3, docs[3][1]), (None, shared[4]), (None, None)]


@pytest.mark.parametrize("seed,most", [(1, 4096), (3, 3)])
def test_equal_to_brute_force(documents, seed, most):
    docs = corpus(seed)
    got = R.without_repeats(documents(docs).repartition(4), most).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == plain(docs)


def test_units_of_a_long_text(documents, monkeypatch):
    monkeypatch.setattr(R, "UNIT", 333)
    docs = corpus(4, 20)
    raw = [(t or "").encode() for _, t in docs]
    starts = Counter()
    for i, at, piece in R._units(raw):
        who, first, last, _, _ = R.anchors([piece])
        for a, b in zip(first, last):
            starts.update((i, at + p) for p in range(a, b + 1))
    assert starts == Counter((i, p) for i, b in enumerate(raw) for p in range(len(b) - 199))


def test_merged_interleave_is_the_sorted_order():
    rng = random.Random(5)
    strings = [bytes(rng.choices(b"ab\0c", k=rng.randint(1, 40))) for _ in range(60)]
    shards = [R.Transform(strings[i:i + 7]) for i in range(0, 60, 7)]
    order, block = R.merge(shards, rounds=12)
    size = np.array([len(s.order) for s in shards])
    at = np.concatenate([s.order + b for s, b in zip(shards, np.cumsum(size) - size)])[order]
    flat = [x + 1 for s in strings for x in [*s, -1]]
    ends = [i for i, x in enumerate(flat) if x == 0]
    part = [tuple(flat[a:min(a + 12, next(e for e in ends if e >= a) + 1)]) for a in at]
    assert all(x <= y for x, y in zip(part, part[1:]))
    whole = [p for p in part if len(p) == 12 and 0 not in p]
    assert len({b for p, b in zip(part, block) if p in set(whole)}) == len(set(whole))


def test_empty_table(documents):
    assert R.without_repeats(documents([])).collect() == []
