import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluice.llm import packing

PATH = P.path("word_bpe_49k.json")
ODD = ["", " ", "a", "Don't we'll ''s x'D", "naïve Straße ½ 3rd", "İ ΣΑΣ", "日本 語", "<|endoftext|> tail", "a\x1cb c", "x\U0001F600y", "'", "a'"]


TOKENIZER = Tokenizer.from_file(PATH)


def plain_ids(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers():
    enc = packing.WordEncoder(PATH)
    texts = ODD + [" ".join(random.Random(1).choices(["Hello,", "world's", "(42)", "Überraschung"], k=50))]
    for _ in range(2):
        assert [i.tolist() for i in enc.ids(texts)] == [plain_ids(t) for t in texts]
    assert [enc.ids([t])[0].tolist() for t in texts] == [plain_ids(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abR'st lé½.,!\n", max_size=30), min_size=1, max_size=4))
def test_ids_of_any_text(texts):
    assert [i.tolist() for i in packing.encoder(PATH).ids(texts)] == [plain_ids(t) for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), min_size=1, max_size=5), st.integers(0, 20))
def test_fullest_is_the_best_subset(counts, room):
    items = [k for k, n in counts.items() for _ in range(n)]
    best = max(s for r in range(len(items) + 1) for c in itertools.combinations(items, r) if (s := sum(c)) <= room)
    got = packing.fullest(sorted(counts, reverse=True), counts, room)
    assert sum(k * n for k, n in got) == best and all(n <= counts[k] for k, n in got)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 200), max_size=12))
def test_plan_covers_the_histogram(histogram):
    left = defaultdict(int, histogram)
    for bins, per in packing.plan_bins(histogram, 40):
        assert bins > 0 and sum(k * n for k, n in per) <= 40
        for k, n in per:
            left[k] -= n * bins
    assert not any(left.values())


def check(rows, docs, capacity):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for off, length in sorted(own):
            assert off == at
            at += length
        assert at <= capacity
    for i, t in docs:
        ids = plain_ids(t or "") + [1]
        want = [(p, s, len(ids[s:s + capacity]), zlib.crc32(np.asarray(ids[s:s + capacity], "<u4").tobytes()))
                for p, s in enumerate(range(0, len(ids), capacity))]
        assert sorted(x for x in pieces[i] if x in want) == sorted(want * sum(d == (i, t) for d in docs))
    return len(bins)


def test_pack_equals_brute_force(documents):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices(["alpha", "beta,", "gamma!", "delta"], k=rng.randint(0, 60)))) for i in range(60)]
    docs += [(100 + i, t) for i, t in enumerate(ODD)] + [(200, None), (7, docs[7][1]), (300, "tick " * 500)]
    got = packing.pack(documents(docs).repartition(5), PATH, capacity=64).collect()
    assert check(got, docs, 64) <= sum(r.length for r in got) // 64 + 3


def test_pack_empty_table(documents):
    assert packing.pack(documents([]), PATH).collect() == []
