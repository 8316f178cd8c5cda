import random

import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluice.llm import tokencount as C

PATH = P.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True


def plain(text):
    return len(PLAIN.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.text("ab'srel \n.1é", max_size=60), st.lists(st.tuples(st.integers(0, 70), st.integers(0, 12), st.text("a's \n.", max_size=9)), max_size=4))
def test_counts_after_edits_equal_a_full_encoding(text, edits):
    count = C.counter(PATH)
    tree = C.build(text, count)
    assert tree.tokens == plain(text) and tree.chars == len(text)
    for start, n, insert in edits:
        start = min(start, len(text))
        end = min(start + n, len(text))
        tree, new, _ = C.apply(tree, text, start, end, insert, count)
        text = text[:start] + insert + text[end:]
        assert new == text and tree.tokens == plain(text) and tree.chars == len(text)


def test_long_texts_encode_little_again():
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(20000))
    count = C.counter(PATH)
    tree = C.build(text, count)
    for _ in range(30):
        at = rng.randrange(len(text))
        tree, text, again = C.apply(tree, text, at, min(len(text), at + rng.randrange(30)), rng.choice(["", "xyz", "  ", "\n\n" * 30]), count)
        assert again < 1500
    assert tree.tokens == plain(text)
    tree, text, _ = C.apply(tree, text, 50, 60, "word " * 5000, count)
    assert tree.tokens == plain(text)


def test_recount_equals_brute_force(documents):
    docs = [(1, "It's a test, isn't it?" * 9), (2, None), (3, ""), (None, "a b"), (4, "日本語 \U0001F600 <|endoftext|> x"), (1, "It's a test, isn't it?" * 9), (5, "w " * 90000)]
    got = C.recount(C.with_edits(documents(docs)), "edits", PATH).collect()
    want = []
    for i, t in docs:
        new = t or ""
        n = len(new)
        for a, b, s in ([(int(n / 2), int(n / 2 + 20), new[:24][::-1]), (int(n / 5), int(n / 5 + 9), ""), (n + 24, n + 24, " it's done 42")] if t is not None else [(0, 0, ""), (0, 0, ""), (0, 0, " it's done 42")]):
            new = new[:a] + s + new[max(a, b):]
        want.append((str(i), plain(t or ""), plain(new), len(new)))
    assert sorted((str(r.doc_id), r.n_tokens, r.edited_tokens, r.edited_chars) for r in got) == sorted(want)


def test_empty_table(documents):
    assert C.recount(C.with_edits(documents([])), "edits", PATH).collect() == []
