"""Texts cut into pieces many at a time: the library's ids, and no work per word that is known."""

import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from breezemart.llm.tokens import Encoder, vocabulary

BLANKS = "   \n\n\t\r\x0b\x0c\x1c\x1f\x85\xa0       　᠎​﻿"
SIGNS = "\0aabzAZ019²½,.:!([-_`{~@#$&|<>/\\'\"ªºÀÖ×Øö÷øÿĀſǀɎɏɐʰдЖ中ひ한😀é"


@pytest.fixture(scope="module")
def plain():
    library = Tokenizer.from_file(vocabulary())
    return lambda text: np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_any_text_has_the_ids_of_the_library(plain):
    rng, own = random.Random(11), Encoder(vocabulary())
    signs = [*BLANKS, *SIGNS, *" " * 25, "'s", "'t", " '", " 1", "<|endoftext|>"]
    texts = [None, "", *("".join(rng.choices(signs, k=rng.randint(1, rng.choice([3, 9, 40])))) for _ in range(3000))]
    want = [plain(t) for t in texts]
    for kind in (pa.string(), pa.large_string()):
        assert list(own.encode_all(pa.array(texts, kind))) == want
    assert list(own.encode_all(pa.array(texts, pa.string()).slice(7, 90))) == want[7:97]


def test_digits_and_brackets_need_no_call_of_the_whole_library(plain):
    own, calls = Encoder(vocabulary()), []
    whole, own._whole = own._whole, lambda text: calls.append(text) or whole(text)
    texts = ["(ab12) x1\n2.5 [é], 7", "12", "a-b_c (d)\n(e"]
    assert list(own.encode_all(pa.array(texts))) == [plain(t) for t in texts]
    assert not calls


def test_known_words_cost_no_call_each_whatever_stands_beside_them(plain):
    own, rng = Encoder(vocabulary()), random.Random(2)
    words = ["".join(rng.choices("abcdeé", k=6)) for _ in range(2000)]
    own.encode("x " + " ".join(words) + " x, x. x,\nx")
    text, calls = "x " + " ".join([w + rng.choice([",", ".", ",\nx"]) for w in words]), []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        ids = own.encode(text)
    finally:
        sys.setprofile(None)
    assert ids == plain(text)
    assert len(calls) < 1000
