"""Wavelet matrix files: round trips, and rank and select against lists."""

import random
import zlib

import numpy as np
import pytest
from cohortloom.llm import wavelet
from cohortloom.llm.queries import QUERIES
from cohortloom.llm.tokens import Encoder, can_be_cut, tokenizer_path

TEXTS = [
    "", " ", "  two  spaces ", "a\n\nb", "line.\nNext line, of it's 12 words", "tab\tand\rreturn", "été   x",
    "<|endoftext|> x<|endoftext|>y <|startoftext|>", "ΣΣ İ ﬁ ☃☃ don't we'll 3.14 a--b\x0bc\x1c d",
    "trailing \n", "\nleading", " a b", "中文 \U0001f600 text", "ÀÉ ŉ ſ Ĳ ÿ × ÷ ß", "DON'T 'S _a_ __ a_b x²", "a,.b ., a,b.c",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(documents, name, monkeypatch):
    from tokenizers import Tokenizer

    from cohortloom.llm import tokens

    encode, plain = Encoder(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    assert encode.cut
    rng = random.Random(3)
    odd = " \t\n\r\x0b\x0c\x1c\x1f\x85\u00a0\u2003\u2028\u3000\u200b.,'!sSΣσé\u0301\u0308İ1²a中\U0001f600<|>_-"
    random_texts = ["".join(rng.choices(odd, k=rng.randint(1, 30))) for _ in range(3000)]
    words = ["".join(rng.choices("abc'dé ", k=60)) for _ in range(50)]
    texts = [*TEXTS, *(r.text for r in documents.collect()), *random_texts, *words, "x" * 50_000, "a b " * 20_000]
    # Forgets what it holds now and then.
    monkeypatch.setattr(tokens, "HELD", 700)
    monkeypatch.setattr(tokens, "AT_ONCE", 50)
    monkeypatch.setattr(tokens, "CHARACTERS", 5000)
    for text, ids in zip(texts, encode.each(texts), strict=True):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, text[:80]
    assert len(encode.held) <= 700


def test_files_of_unknown_kinds_are_encoded_whole():
    known = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}, "normalizer": None, "added_tokens": []}
    assert can_be_cut(known)
    for change in (
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}},
        {"pre_tokenizer": {"type": "Metaspace"}},
        {"pre_tokenizer": None},
        {"pre_tokenizer": {"type": "Split", "pattern": {"Regex": "[a-z ]+"}}},
        {"normalizer": {"type": "Strip"}},
        {"added_tokens": [{"content": "<x>", "lstrip": True, "rstrip": False}]},
    ):
        assert not can_be_cut({**known, **change})


@pytest.mark.parametrize("n", [0, 1, 7, 512, 513, 5000])
def test_access_count_select(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 40, n).astype(np.uint16)
    matrix = wavelet.WaveletMatrix(wavelet.build(np.array([5]), np.array([n]), ids, 6))
    assert matrix.decode().tolist() == ids.tolist()
    for i in rng.integers(0, max(n, 1), min(n, 30)):
        assert matrix.access(int(i)) == ids[i]
    for token in (0, 3, 39, 40, 63, 64):
        where = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(where)
        assert matrix.count(token, n // 3, n // 2) == int((ids[n // 3 : n // 2] == token).sum())
        assert [matrix.select(token, k) for k in range(len(where))] == where.tolist()
        with pytest.raises(IndexError):
            matrix.select(token, len(where))


def brute(rows, plain):
    out, start = [], 0
    for i, text in sorted(rows):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def test_query_equals_brute_force(spark, root, documents):
    got = sorted(tuple(r)[:4] for r in QUERIES["op3_wavelet_shards"](spark, root).collect())
    assert got == brute([(r.doc_id, r.text) for r in documents.collect()], plain())


def test_odd_rows_in_small_shards(odd):
    got = wavelet.encode_and_read(odd, tokenizer_path("word_bpe_49k.json"), shard_tokens=50)
    rows = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got.collect())
    assert [r[1] for r in rows] == sorted(r.doc_id for r in odd.collect() if r.doc_id is not None)
    assert [r[0] for r in rows] == [sum(x[2] for x in rows[:k]) for k in range(len(rows))]
    sizes = sorted((r[1], r[2], r[3]) for r in rows)
    wanted = sorted((i, n, c) for i, _, n, c in brute([(r.doc_id, r.text or "") for r in odd.collect() if r.doc_id is not None], plain()))
    assert sizes == wanted


def test_no_rows(nothing):
    assert wavelet.encode_and_read(nothing, tokenizer_path("word_bpe_49k.json")).count() == 0


def test_query_keeps_null_ids(spark, odd, tmp_path):
    more = [(None, None), (None, "a text of no id"), (None, "naïve text"), (-5, "x"), (0, "id zero"), (2**62 + 1, "y")]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(QUERIES["op3_wavelet_shards"](spark, str(tmp_path)).collect(), key=lambda r: r.start)
    every = docs.collect()
    ids = [r.doc_id for r in rows]
    assert ids == [None] * 4 + sorted(r.doc_id for r in every if r.doc_id is not None)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    # Null ids are told from 0; ids and contents belong together.
    wanted = [(r.doc_id, *brute([(0, r.text or "")], plain())[0][2:]) for r in every]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=repr) == sorted(wanted, key=repr)


def test_files_flag_null_ids(spark, odd, tmp_path):
    path = f"{tmp_path}/shards"
    wavelet.write_shards(odd, path, tokenizer_path("word_bpe_49k.json"), shard_tokens=50, keep_null_ids=True)
    shards = [wavelet.WaveletMatrix(r.file) for r in spark.read.parquet(path).orderBy("part", "seq").collect()]
    ids = [int(i) if ok else None for s in shards for i, ok in zip(s.doc_ids, s.valid)]
    assert ids == [None, *sorted(r.doc_id for r in odd.collect() if r.doc_id is not None)]


def test_texts_are_cut_at_the_same_places_without_looking_at_each(documents):
    from cohortloom.llm.tokens import CUT, parts_of

    rng = random.Random(5)
    made = ["".join(rng.choices("ab é.,\n\t\x00 ", k=rng.randint(1, 20))) for _ in range(5000)]
    for text in [*TEXTS, *made, *(r.text for r in documents.collect() if r.text)]:
        assert parts_of(text) == CUT.split(text), text[:80]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_are_encoded_joined(name, monkeypatch):
    encode, listed = Encoder(tokenizer_path(name)), []
    real = Encoder._listed
    monkeypatch.setattr(Encoder, "_listed", lambda self, parts, out: listed.extend(parts) or real(self, parts, out))
    words = [f" {a}{b}" for a in ("x", "Ünder", "ß", "WORD", "lerieux") for b in ("a", "é", "Qu", "tion")]
    found = encode._encoded([*words, ".", " 12", "first"])
    assert sorted(listed) == [" 12", ".", "first"]
    assert all(found[w] == encode._whole(w).tobytes() for w in (*words, ".", " 12", "first"))
