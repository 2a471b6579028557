"""Parts that the library is given, and how a text's ids are put together from them."""

import numpy as np
import pytest

from cohortloom.llm.tokens import Encoder, tokenizer_path, words_among

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
TEXTS = [
    "One line\nAnother line, of words.\nLast über\nÉtude", "", None, "a", "\nopens so", "two  spaces\tand a\0zero",
    "a\0 b c", "word### word### 12.5, x.y", "Один два, три.\nЧетыре", "end\n",
]


@pytest.fixture(scope="module", params=FILES)
def encode(request):
    return Encoder(tokenizer_path(request.param))


def test_ids_are_those_of_whole_texts(encode):
    for some in (TEXTS, TEXTS[::-1], TEXTS * 2, [None], [""], [], ["a\0 b"]):
        for text, ids in zip(some, encode.ids_of(some), strict=True):
            assert ids.tolist() == encode.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_after_line_ends_are_joined(encode, monkeypatch):
    encode.held = {}
    listed = []
    alone = encode._listed
    monkeypatch.setattr(encode, "_listed", lambda parts, out: (listed.extend(parts), alone(parts, out)))
    encode.ids_of(["first line\nSecond line\nThird"])
    assert listed == ["first"]


def test_different_parts_are_looked_up_once_for_all_texts(encode, monkeypatch):
    looked_up = []
    look_up = encode._looked_up
    monkeypatch.setattr(encode, "_looked_up", lambda parts: (looked_up.append(parts), look_up(parts))[1])
    encode.ids_of(["a b a b", "b a b", "a\tb"])
    (parts,) = looked_up
    assert sorted(parts) == sorted({"a", " b", " a", "b", "\tb"})


def test_words_among_parts_that_hold_the_mark():
    assert words_among([" a", "b", "\nc", " d.", " é"]) == [" a", "\nc", " é"]
    assert words_among(["x\0 a\0y", " b"]) == [" b"]
    assert words_among([]) == []


def test_forgotten_parts_are_encoded_again(encode, monkeypatch):
    monkeypatch.setattr("cohortloom.llm.tokens.HELD", 4)
    text = "one two three four five six seven"
    for _ in range(3):
        assert np.array_equal(encode.ids(text), encode.tokenizer.encode(text, add_special_tokens=False).ids)
        assert len(encode.held) <= 4
