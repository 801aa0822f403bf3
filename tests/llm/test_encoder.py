"""Token ids of the piecewise encoder against the library's whole call, and
the grammar's pair counts against a plain count."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rankflow.llm import bpe, repair

PATH = bpe.default_path()
PARTS = st.sampled_from(["a", "The", "é", "ß,", "×", "ª", "'s", "'", "don't", "7", "3rd", "...", "$5", "→", " ", "\x00", "\x1c",
                         "漢字", " ", "  ", "\n", "\n\n", "\t", "\r\n", "<|endoftext|>", " ", "😀!", "x" * 40])
TEXTS = st.lists(st.one_of(st.lists(PARTS, max_size=12).map("".join),
                           st.lists(PARTS.filter(lambda p: not p.isspace()), max_size=12).map(" ".join), st.text(max_size=20)),
                 min_size=1, max_size=6)


def ids(data, kind="<u4"):
    return np.frombuffer(data, kind).tolist()


@pytest.mark.parametrize("as_text", [True, False])
@settings(max_examples=150, deadline=None)
@given(texts=TEXTS)
def test_encoder_equals_the_library(as_text, texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = as_text
    encode = bpe.encoder(PATH, "<u4", as_text, 5)    # forgets what it knows again and again
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert [ids(x) for x in encode(texts)] == want
    assert [ids(x) for x in encode(texts + [None, ""])] == want + [[], []]


def test_long_texts_are_cut_at_separators(monkeypatch):
    monkeypatch.setattr(bpe._stretches, "__defaults__", (50,))
    monkeypatch.setattr(bpe, "STRETCH", 50)
    t = Tokenizer.from_file(PATH)
    encode = bpe.Encoder(PATH, "<u4")
    texts = ["one two, three\nfour five " * 20 + "end", "a" * 120 + " b\n" + "c" * 70 + " d", "w" * 9000 + " x", "short one"]
    assert ["".join(bpe._stretches(x)) for x in texts] == texts
    assert [ids(x) for x in encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    encode = bpe.Encoder(path, "<u4")
    texts = ["Hello  world, don't", "a b\nc"]
    assert not encode.cuts
    assert [ids(x) for x in encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


@settings(max_examples=60, deadline=None)
@given(seq=st.lists(st.integers(0, 6), max_size=300), least=st.integers(2, 6), bits=st.sampled_from([1, 3, 20]))
def test_grammar_with_crowded_counters(seq, least, bits):
    """Pairs that share a counter are told apart: the sequence comes back, and
    no pair is frequent in what is left."""
    before, repair._HASH_BITS = repair._HASH_BITS, bits
    try:
        left, right, length, rest = repair.compress(np.array(seq, np.uint32), 10, least)
    finally:
        repair._HASH_BITS = before

    def grow(x):
        return [x] if x < 10 else grow(int(left[x - 10])) + grow(int(right[x - 10]))

    assert [y for x in rest.tolist() for y in grow(x)] == seq
    assert [len(grow(10 + k)) for k in range(len(left))] == length.tolist()
    pairs, apart, last = {}, {}, {}
    for k, p in enumerate(zip(rest.tolist(), rest.tolist()[1:])):
        pairs[p] = pairs.get(p, 0) + 1
        if last.get(p) != k - 1:    # occurrences that overlap count once
            apart[p], last[p] = apart.get(p, 0) + 1, k
    assert all(pairs[p] < least or apart[p] < pairs[p] for p in pairs)
