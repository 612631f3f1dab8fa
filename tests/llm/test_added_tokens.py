"""Ids of texts that hold an added token, against the library's plain call."""

import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from breezemart.llm import range_coder
from breezemart.llm import tokens as token_module
from breezemart.llm.packing import pack
from breezemart.llm.tokens import Encoder, vocabulary

TEXTS = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b c", "a\n<|endoftext|> \n b", "<|endoftext|><|endoftext|> it's",
         "<|endoftext> <| endoftext|>", "x y", "  <|endoftext|>  é 1", "some words first <|endoftext|>"]


def plain(text):
    ids = Tokenizer.from_file(vocabulary()).encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


def test_added_tokens_are_one_id():
    own = Encoder(vocabulary())
    for _ in range(2):
        assert [own.encode(t) for t in TEXTS] == [plain(t) for t in TEXTS]
    assert np.frombuffer(own.encode(TEXTS[0]), "<u4").tolist() == [87, 220, 50256, 331]


def test_queries_give_those_ids(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    at, end = 0, bytes(4)
    for r in sorted(range_coder.coded_ids(docs, vocabulary()).collect(), key=lambda r: r.doc_id):
        raw = plain(TEXTS[r.doc_id]) + end
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(raw) // 4, zlib.crc32(raw))
        at += r.n_tokens
    packed = {r.doc_id: (r.length, r.ids_crc32) for r in pack(docs, vocabulary(), 0).collect()}
    assert packed == {i: (len(plain(t) + end) // 4, zlib.crc32(plain(t) + end)) for i, t in enumerate(TEXTS)}


def test_many_texts_at_once_give_those_ids_with_few_calls_of_the_whole_library():
    own, calls, rng = Encoder(vocabulary()), [], random.Random(3)
    whole, own._whole = own._whole, lambda text: calls.append(text) or whole(text)
    plain_texts = ["Wort " + " ".join("".join(rng.choice("abcdeäß") for _ in range(9)) + rng.choice(["", ".", ",\nNeu"])
                                      for _ in range(50)) for _ in range(200)]
    assert list(own.encode_all(pa.array(plain_texts))) == [plain(t) for t in plain_texts]
    assert not calls  # once a call of the library per text with a new word
    odd = [None, "", " ", "a  b", "a\n b", "it's 12 ab12", "\n a", "x　 y", *TEXTS, *plain_texts[:5], "a " * 30, "''s -- 's"]
    odd += ["".join(rng.choice("   \naé.b,1'") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    for _ in range(2):
        assert list(own.encode_all(pa.array(odd, pa.string()))) == [plain(t or "") for t in odd]
    assert list(own.encode_all(pa.array(odd, pa.string()).slice(3, 9))) == [plain(t or "") for t in odd[3:12]]


def test_slices_and_full_caches_change_nothing(monkeypatch):
    texts = [*TEXTS, *(f"word{i} other{i} abc{chr(97 + i % 26)}, d" * (i % 7) for i in range(200)), "x" * 3000, None, ""]
    want = [plain(t or "") for t in texts]
    for name, value in (("SLICE", 50), ("CACHE_WORDS", 3), ("CACHE_CHARS", 3)):
        monkeypatch.setattr(token_module, name, value)
        own = Encoder(vocabulary())
        assert list(own.encode_all(pa.array(texts))) == want == [own.encode(t) for t in texts]
    assert list(Encoder(vocabulary()).encode_all(pa.array([], pa.string()))) == []
