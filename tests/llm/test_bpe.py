"""Tree concatenation against the library on whole texts."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

from tests.llm.conftest import edge_rows, plain
from tillmart.llm import bpe_tree
from tillmart.llm.bpe_tree import TEXT, Codec, codec_of, cut, encode_decode, encoded_part, joined_ids, tokenizer_spec
from tillmart.llm.queries import tokenizer_path

SMALL = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
ALPHABETS = ["ab", "abcdefghij", "the inonér' 's1", "éñßábAB 　\x85x", "aaaaaaab", "中文字a ", "'sStT'dDLl rRve.", "e\u0301\u0323o\u0308 x", "0f3a9c7b1d \n", "👍🏽é-- '"]


@pytest.fixture(scope="module")
def codec():
    return Codec(tokenizer_spec(tokenizer_path()))


def in_parts(codec: Codec, text: str, most: int) -> list[int]:
    parts = [(piece, kind, body, *encoded_part(codec, kind, last, body)) for piece, kind, last, body in cut(codec, text, most)]
    return np.frombuffer(joined_ids(codec, parts), dtype="<u4").tolist()


@pytest.mark.parametrize("seed", range(6))
def test_parts_give_the_encoding_of_the_whole(codec, seed):
    rng = random.Random(seed)
    for _ in range(150):
        letters = rng.choice(ALPHABETS)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 200)))
        if rng.random() < 0.1:
            text = text.replace("a", "<|endoftext|>")
        assert in_parts(codec, text, rng.choice([2, 3, 7, 16, 40])) == codec.ids(text), text


def test_long_supplied_texts_meet_at_any_place(codec, spark):
    """Every join of texts that are cut where their middle falls, the longest of them at all sizes of part."""
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").where("length(text) > 2000").collect()]
    assert texts
    codec.joins = codec.widened = 0
    for text in texts:
        for most in (199, 1000):
            assert {kind for _, kind, _, _ in cut(codec, text, most)} == {TEXT}
            assert in_parts(codec, text, most) == codec.ids(text)
    assert 0 < codec.widened < codec.joins


def test_added_tokens_over_a_join(codec):
    for before in range(40):
        text = "x" * (before % 7) + " y" * before + "<|endoftext|>" + "it's 'Re " * 4
        assert in_parts(codec, text, 30) == codec.ids(text), text


def test_ascii_words_against_the_library(codec):
    rng = random.Random(3)
    signs = [chr(i) for i in range(128)] + list("'''sstdmllvere ABC")
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 30)))
        assert np.frombuffer(codec.packed(text.encode()), dtype="<u4").tolist() == codec.ids(text), repr(text)


@pytest.mark.parametrize("long", [50, 1 << 15])
def test_encode_decode_against_the_library(docs, codec, long):
    want = []
    for doc_id, text, *_ in edge_rows():
        ids = codec.ids(text or "")
        want.append((doc_id, bytearray(np.array(ids, dtype="<u4").tobytes()), codec.whole.decode(ids, skip_special_tokens=False)))
    assert plain(encode_decode(docs, tokenizer_path(), long)) == sorted(want, key=repr)


def test_nothing_and_tokenizers_that_join_words(no_docs):
    assert encode_decode(no_docs, tokenizer_path()).collect() == []
    with pytest.raises(ValueError, match="over white space"):
        encode_decode(no_docs, tokenizer_path("byte_bpe_50k.json"))


def test_parts_of_long_texts_take_words_that_are_known():
    """A part's words are encoded once, as those of short texts are; their tokens have the place of their word."""
    codec = Codec(tokenizer_spec(tokenizer_path()))
    text = " Unwieldy  words,\twords " + "unwieldy words " * 5
    found = codec.stretch(text)
    assert found.ids.tolist() == codec.ids(text)
    assert set(codec.words) == set(text.encode().split())
    assert {text[s - 1].isspace() for s in found.starts.tolist()} == {True}


def test_a_worker_keeps_one_codec_and_few_words(monkeypatch):
    """What a process holds grows neither with its tasks nor with the words it meets, and what it forgot it finds again."""
    monkeypatch.setattr(bpe_tree, "CACHE", 50)
    spec = tokenizer_spec(tokenizer_path())
    codec = codec_of(spec)
    rng = random.Random(5)
    for _ in range(60):
        text = " ".join(["often", "Often,", "é", *(f"{rng.choice('aeiou')}x{rng.randrange(400)}-{rng.randrange(9)}" for _ in range(12))])
        assert np.frombuffer(codec_of(spec).packed(text.encode()), dtype="<u4").tolist() == codec.ids(text)
        for held in (codec.words, codec.words_before, codec.pieces, codec.pieces_before):
            assert len(held) <= 50
    assert codec_of(spec) is codec
    assert b"often" in codec.words
    assert codec_of(spec + " ") is not codec
    assert len(bpe_tree._codecs) == 1
