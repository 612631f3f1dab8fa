"""Ids and decoded texts against the plain library call and against merging pair by pair."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from breezemart.llm import queries
from breezemart.llm.prefix_bpe import Codec, decode, digests, encode, round_trip, vocabulary


@pytest.fixture(scope="module")
def library():
    plain = Tokenizer.from_file(vocabulary())
    plain.no_truncation()
    plain.no_padding()
    return plain


@pytest.fixture(scope="module")
def own():
    return Codec(vocabulary())


def expected(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=str)


def test_query_equals_the_library(spark, sf_dir, documents, library):
    found = queries.QUERIES["op11_prefix_bpe"](spark, sf_dir).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = [expected(library, r.doc_id, r.text) for r in documents.collect()]
    assert in_order(map(tuple, found.collect())) == in_order(want)


def test_odd_rows(spark, edge, empty, library):
    found = digests(round_trip(edge, vocabulary())).collect()
    assert in_order(map(tuple, found)) == in_order(expected(library, r.doc_id, r.text) for r in edge.collect())
    assert round_trip(empty, vocabulary()).count() == 0
    assert encode(empty, vocabulary()).columns == ["doc_id", "ids"]


def test_encode_then_decode_is_the_round_trip(edge):
    path = vocabulary()
    steps = decode(encode(edge, path), path).collect()
    assert in_order(map(tuple, steps)) == in_order((r.doc_id, r.decoded) for r in round_trip(edge, path).collect())


def test_mixed_scripts(own, library):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "b", "th", "e", "in", "ing", "'s", "'", "ll", "'LL", "1", "23", "É", "é", "é",
             "́", "̈́", "ß", "İ", "ſ", "²", "¼", "ª", "ʰ", "ˆ", "Σ", "σας", "日本", "語", "👩‍🚀", "\x00", "\x1c", "\x85",
             "\xa0", " ", "<|endoftext|>", "<|startoftext|>", "<|", "|>", ".", "...", "!!", "aaaa", "😀", "ǅ", "ﬁ",
             "Å", "가", "각", "ḧ", "K"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False), text


@pytest.mark.parametrize("text", ["a" * 60_000, "ab" * 30_001, "e" * 33 + "th" * 900, "!" * 5000])
def test_long_words(own, library, text):
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def merged(own, word):
    """Lowest rank first, leftmost first, one merge at a time."""
    symbols = [*word[:-1], word[-1] + own.suffix]
    ids = [own.words.index(s) for s in symbols]
    while True:
        ranked = [(own.merged[a << 32 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in own.merged]
        if not ranked:
            return ids
        rank, i = min(ranked)
        ids[i:i + 2] = [own.rank.index(rank)]


def test_prefixes_give_what_merging_gives(own):
    rng = random.Random(5)
    for letters in ("ab", "aei", "thein", "lo"):
        for _ in range(60):
            word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 24)))
            assert np.frombuffer(own.word(word), "<u4").tolist() == merged(own, word), word


def test_caches_are_bounded(own, library, monkeypatch):
    monkeypatch.setattr("breezemart.llm.prefix_bpe.CACHE_WORDS", 50)
    monkeypatch.setattr("breezemart.llm.prefix_bpe.CACHE_PAIRS", 50)
    fresh, rng = Codec(vocabulary()), random.Random(7)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(2000))
    assert np.frombuffer(fresh.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(fresh.known) <= 50 and len(fresh.pairs) <= 50


def test_other_kinds_of_file_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError):
        Codec(public_tokenizers.path("byte_bpe_50k.json"))
