"""What a worker keeps of the words it has met is bounded in bytes, and gives the same ids."""

import random
import sys

import pyarrow as pa
from tokenizers import Tokenizer

from breezemart.llm import tokens as token_module
from breezemart.llm.tokens import Encoder, vocabulary


def words(rng, letters, n, length):
    return ["".join(rng.choices(letters, k=length)) for _ in range(n)]


def test_many_different_words_take_bounded_memory():
    rng, tokens = random.Random(3), Encoder(vocabulary())
    latin, cyrillic = "abcdefghijklmnoprstuvwxyz", "абвгдежзиклмнопрстуфхцчшщыэюя"
    texts = [" ".join([x + "," * (i % 2) for i, x in enumerate(words(rng, latin, 3000, 24))]) for _ in range(110)]
    texts += [" ".join(words(rng, cyrillic, 1000, 16)) for _ in range(60)]
    peak = 0
    for i in range(0, len(texts), 10):
        list(tokens.encode_all(pa.array(texts[i:i + 10])))
        caches = {id(x): x for cache in (tokens.words, tokens.parts) for pair in cache.items() for x in pair}
        held = sum(map(sys.getsizeof, caches.values())) + 80 * (len(tokens.words) + len(tokens.parts))
        peak = max(peak, held)
    assert peak < 80 << 20
    plain = Tokenizer.from_file(vocabulary())
    for text in (texts[0], texts[-1]):
        got = pa.py_buffer(tokens.encode(text))
        assert memoryview(got).cast("I").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_words_with_and_without_a_space_are_told_apart(monkeypatch):
    plain = Tokenizer.from_file(vocabulary())
    rows = ["one two, two\none (one) one\ntwo", "two one\none two", "слово слово\nслово", "a-1 x\n\na-1 b  c a-1", "one", " one", "é é, é"]
    for size in (token_module.CACHE_BYTES, 300):
        monkeypatch.setattr(token_module, "CACHE_BYTES", size)
        tokens = Encoder(vocabulary())
        for text in rows * 2:  # the second time from the cache
            assert memoryview(tokens.encode(text)).cast("I").tolist() == plain.encode(text, add_special_tokens=False).ids
