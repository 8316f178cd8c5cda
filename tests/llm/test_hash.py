"""Texts that collide for any polynomial modulo a power of two are told apart."""

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from sluice.llm import common as C
from sluice.llm import fingerprint, jaccard, packing
from .test_packing import check


def thue_morse(n, letters="ab"):
    word = [0]
    while len(word) < n:
        word += [1 - x for x in word]
    return "".join(letters[x] for x in word), "".join(letters[1 - x] for x in word)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_hashes_differ(n):
    hashes = {int(C.span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([n]))[0]) for w in thue_morse(n)}
    assert len(hashes) == 2


def test_hashes_do_not_depend_on_the_place():
    data = np.frombuffer(b"xx" + b"abcabc" * 50 + b"yyabc", np.uint8)
    at = np.arange(2, 302, 3)
    got = C.span_hashes(data, np.append(at, 304), np.append(at + 3, 307))
    assert len(set(got.tolist())) == 1
    wide = np.frombuffer(("é" * 200_000 + "xyz" + "xyz").encode("utf-16-le"), np.uint16)  # sums that need reducing
    a, b = C.span_hashes(wide, np.array([200_000, 200_003]), np.array([200_003, 200_006]))
    assert a == b
    grams = C.gram_hashes(data, 5)
    assert len(grams) == len(data) - 4 and grams[2] == grams[5] and len(C.gram_hashes(data[:3], 5)) == 0


@pytest.mark.parametrize("n", [1024, 2048])
def test_operators_tell_them_apart(documents, n):
    a, b = thue_morse(n)
    docs = [(1, f"{a} x y"), (2, f"{b} x y")]
    assert sorted((r.doc_id, r.component_id) for r in jaccard.groups(documents(docs)).collect()) == [(1, 1), (2, 2)]
    s = fingerprint.sets_of(*fingerprint.digests_of([a, b]), 2)
    x, y = fingerprint.published(s, np.array([0, 1]))
    assert x != y and fingerprint.compare(x, y) == 0.0
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for text, ids in zip((a, b), packing.encoder(path).ids([a, b])):
        assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids
    check(packing.pack(documents(docs), path).collect(), docs, 4096)


def test_words_of_one_hash_are_compared(monkeypatch):
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "span_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    enc = packing.WordEncoder(path)
    texts = ["some words and some more words", "words that all have one hash", "", "some"]
    for _ in range(2):
        for text, ids in zip(texts, enc.ids(texts)):
            assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids
