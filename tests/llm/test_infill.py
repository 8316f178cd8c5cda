import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import infill as I

ALPHABET = "ab\n é€😀<PSM>"


def plain(doc_id, text, unit="line", seed=7, rate=100, spm=50):
    """The transformation in code points, without an index."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or h[2] % 100 >= rate or re.search("<P>|<S>|<M>", text):
        return n, "plain", None, None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), len(s), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), len(s), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=40))
def test_index_converts_every_offset_both_ways(text):
    idx = I.index(np.frombuffer(text.encode(), np.uint8))
    points = np.arange(len(text) + 1)
    want = np.array([len(text[:i].encode()) for i in points])
    assert (I.to_bytes(idx, points) == want).all() and (I.to_points(idx, want) == points).all()
    assert len(idx.byte) == sum(ord(c) > 127 for c in text)  # ASCII is not recorded


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.none(), st.integers(-5, 400)), st.text(ALPHABET, max_size=40), st.sampled_from(I.UNITS), st.integers(0, 100))
def test_equals_the_plain_form(doc_id, text, unit, rate):
    got = I.transform_one(doc_id, text.encode(), unit, 7, rate, 50)
    assert (*got[:-1], got[-1].decode()) == plain(doc_id, text, unit, rate=rate)


ROWS = [(1, None), (2, ""), (3, "one line"), (4, "a\nb\n\nc"), (5, "é\n€uro\n😀\nend"), (6, "a<P>b\nc"), (6, "a<P>b\nc"), (7, "\n"),
        (None, "x\ny\nz"), (8, "<\n<S\n>M>\n<P"), (9, "wörd line\n" * 20000)] + [(100 + i, "ä\nbb\nccc\n<S\n" * 3) for i in range(40)]


@pytest.mark.parametrize("unit", I.UNITS)
def test_rows_and_round_trip(documents, unit):
    done = I.restored(I.transform(documents(ROWS), unit=unit)).collect()
    key = lambda r: tuple(str(x) for x in r)
    want = [(i, *plain(i, t, unit), t or "") for i, t in ROWS]
    assert sorted(map(key, done)) == sorted(map(key, want))
    assert {r.form for r in done} == {"plain", "psm", "spm"}


def test_digests_and_an_empty_table(documents):
    rows = {r.doc_id: r for r in I.digests(documents(ROWS)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for i, t in ROWS:
        n, form, p, m, _, out = plain(i, t)
        assert tuple(rows[i]) == (i, n, form, p, m, sha(out), sha(t or ""))
    assert I.digests(documents([])).collect() == []


def test_unknown_units_are_refused(documents):
    with pytest.raises(ValueError):
        I.transform(documents([(1, "a")]), unit="word")
