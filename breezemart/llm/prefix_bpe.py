"""BPE ids by dynamic programming over prefixes, and back to text.

Merging takes the pair of lowest rank, leftmost first, until none is left. What a merge crosses
depends on the two tokens beside a boundary alone, so a row of tokens is what merging gives exactly
if each token is what merging makes of its own symbols and each neighbouring pair is compatible:
merging both tokens' symbols together gives the same two tokens. Hence every prefix of a word has one
last token, and it is the only token that ends there and is compatible with the last token of the
prefix before it. One pass over the word finds it for every prefix; the back-pointers give the ids.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries of a worker's caches of words and of pairs, and the longest word kept: they bound its
#: memory; what is not kept is worked out again.
CACHE_WORDS, CACHE_CHARS, CACHE_PAIRS = 300_000, 64, 1_000_000
#: Bytes of a batch that a task hands back at once.
BATCH_BYTES = 16 * 2**20
NEVER = 2**31
WORD_END = "\n"  # no symbol: the byte alphabet holds no control characters

# The file's own rules for normalising texts and cutting words.
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
              {"type": "Lowercase"}]
WORD_PATTERN = "|".join([*CONTRACTIONS, r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"])

# Those rules for the Latin code points, whose classes no Unicode version changes: normalised and
# lower-cased as usual, cut by one pattern. Other texts go through the library's rules.
LATIN_END = 0x370
_OTHER = re.compile(f"[^\x00-{chr(LATIN_END - 1)}]").search


def _latin_words():
    latin = list(map(chr, range(LATIN_END)))
    letters, numbers = ("".join(re.escape(c) for c in latin if unicodedata.category(c)[0] == kind) for kind in "LN")
    spaces = r"\t-\r \x85\xa0"
    return re.compile("|".join([*CONTRACTIONS, f"[{letters}]+", f"[{numbers}]", f"[^{spaces}{letters}{numbers}]+"])).findall


def _byte_symbols() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    moved = {b: 256 + k for k, b in enumerate(others)}
    return [chr(moved.get(b, b)) for b in range(256)]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Codec:
    """Encoder and decoder of a vocabulary file: a BPE of byte symbols whose words end in a suffix.

    Refuses a file that asks for more: unknown or continuation symbols, dropout, merges that are not
    in rank order, other rules for words, added tokens that strip or need a word to themselves, normalised ones, a decoder.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, added = rules["model"], rules["added_tokens"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
               if model.get(k)]
        odd += [k for a in added for k in ("single_word", "lstrip", "rstrip", "normalized") if a[k]]
        if model["type"] != "BPE" or odd or rules["decoder"]:
            raise ValueError(f"{path}: no plain BPE of words, {odd or model['type'] or 'decoder'}")
        whole = Tokenizer.from_file(path)
        self.normal, self.cut = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        split, *rest = rules["pre_tokenizer"]["pretokenizers"]
        known = (rules["normalizer"].get("normalizers") == NORMALIZER and split["behavior"] == "Removed" and split["invert"]
                 and split["pattern"] == {"Regex": WORD_PATTERN} and [r["type"] for r in rest] == ["ByteLevel"]
                 and not rest[0]["add_prefix_space"] and not rest[0]["use_regex"])
        if not known:
            raise ValueError(f"{path}: other rules for words than those known here")
        self.latin, self.symbols = _latin_words(), _byte_symbols()
        self.suffix = model.get("end_of_word_suffix") or ""
        ids: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]

        self.words = [""] * (1 + max([*ids.values(), *[a["id"] for a in added]], default=0))
        for word, at in [*ids.items(), *[(a["content"], a["id"]) for a in added]]:
            self.words[at] = word
        self.added = {a["content"]: a["id"] for a in added}
        self.at_added = re.compile("(" + "|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) + ")")

        size = len(self.words)
        self.rank, self.left, self.right = array("i", [-1]) * size, array("i", [-1]) * size, array("i", [-1]) * size
        self.merged: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, both = ids[a], ids[b], ids[a + b]
            if max(self.rank[left], self.rank[right]) >= rank or self.rank[both] >= 0:
                raise ValueError(f"{path}: merges are not in rank order at {rank}")
            self.merged[left << 32 | right] = self.rank[both] = rank
            self.left[both], self.right[both] = left, right
        self.sound = self._sound(ids, merges)
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.tokens = ahocorasick.Automaton()
        for word, at in ids.items():
            closing = bool(self.suffix) and word.endswith(self.suffix)
            symbols = word[:-len(self.suffix)] + WORD_END if closing else word
            if self.sound[at] and symbols != WORD_END:
                self.tokens.add_word(symbols, (at, len(symbols)))
        self.tokens.make_automaton()

    def _sound(self, ids: dict[str, int], merges: list) -> bytearray:
        """Tokens that merging makes of their own symbols; no other ever appears."""
        sound = bytearray(b"\x01") * len(self.words)
        for a, b in merges:
            left, right, both = ids[a], ids[b], ids[a + b]
            sound[both] = sound[left] and sound[right] and self._apart(left, right, self.rank[both], self.rank[both])
        return sound

    def _apart(self, a: int, b: int, a_ends: int = NEVER, b_ends: int = NEVER) -> bool:
        """Whether no merge crosses from `a` to `b`, which are merged away at `a_ends` and `b_ends`.

        Goes back in time along the tokens at the boundary. Of equal pairs in a run the leftmost
        merges first, so a merge at the very rank that ends `b` crosses, and at that of `a` not.
        """
        rank, merged = self.rank, self.merged
        while True:
            at = merged.get(a << 32 | b)
            if at is not None and at < a_ends and at <= b_ends:
                return False
            if rank[a] > rank[b]:
                a_ends, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                b_ends, b = rank[b], self.left[b]
            else:
                return True

    def _compatible(self, a: int, b: int) -> bool:
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        found = self.pairs[a << 32 | b] = self._apart(a, b)
        return found

    def word(self, symbols: str) -> bytes:
        """Ids of a word of byte symbols: the last token of every prefix, then the way back."""
        if self.suffix:
            symbols += WORD_END
        n = len(symbols)
        last: list[int | None] = [None] * (n + 1)
        lengths, pairs, compatible = [0] * (n + 1), self.pairs, self._compatible
        last[0] = NEVER
        for end, (token, length) in self.tokens.iter(symbols):
            if last[end + 1] is None:
                before = last[end + 1 - length]
                if before is None:
                    continue
                fits = length > end or pairs.get(before << 32 | token)
                if fits or fits is None and compatible(before, token):
                    last[end + 1], lengths[end + 1] = token, length
        ids, at = [], n
        while at:
            if last[at] is None:
                raise ValueError(f"no token of the vocabulary ends the first {at} symbols of {symbols[:40]!r}")
            ids.append(last[at])
            at -= lengths[at]
        return np.array(ids[::-1], "<u4").tobytes()

    def _learn(self, word: str, symbols: str | None = None) -> bytes:
        if symbols is None:
            symbols = "".join([self.symbols[b] for b in word.encode()])
        ids = self.word(symbols)
        if len(word) <= CACHE_CHARS:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def _part(self, text: str) -> Iterator[bytes]:
        plain = unicodedata.normalize("NFC", text).lower()
        if not _OTHER(plain):
            known, learn = self.known.get, self._learn
            for word in self.latin(plain):
                yield known(word) or learn(word)
        elif " " in text:
            for chunk in text.split(" "):  # no rule joins what a space divides
                yield from self._part(chunk)
        else:
            for symbols, _ in self.cut(self.normal(text)):
                yield self.word(symbols)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; added tokens are cut out of
        the text as it came."""
        if not text:
            return b""
        if not any(a in text for a in self.added):
            return b"".join(self._part(text))
        out = []
        for k, part in enumerate(self.at_added.split(text)):
            out += [np.array([self.added[part]], "<u4").tobytes()] if k % 2 else self._part(part)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens one by one, a space between two: the file names no decoder that joins them."""
        words = self.words
        return " ".join([words[i] for i in np.frombuffer(ids, "<u4").tolist()])


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _batched(rows: Iterator[list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of about `BATCH_BYTES`, so that long texts do not add up in a worker."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _mapped(df: DataFrame, fields: list[T.StructField], row) -> DataFrame:
    schema = T.StructType(fields)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        def rows():
            for batch in batches:
                for values in zip(*batch.columns):
                    yield row(*[v.as_py() for v in values])

        yield from _batched(rows(), to_arrow_schema(schema))

    return df.mapInArrow(convert, schema)


def encode(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """`key` and `ids` (binary, little-endian unsigned 32-bit integers) for every row of `docs`.

    Ids equal those of the tokenizers library for the same file, added tokens included, none added.
    A null or empty text has no ids; repeated rows and null keys stay as they are; an empty table
    gives no rows; other columns are not looked at. No row is moved: each task reads its texts.
    """
    fields = [docs.schema[key], T.StructField("ids", T.BinaryType())]
    return _mapped(docs.select(key, "text"), fields, lambda at, text: [at, codec(path).encode(text)])


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """`key` and `decoded` for rows of `encode`; null ids give a null text."""
    fields = [encoded.schema[key], T.StructField("decoded", T.StringType())]
    return _mapped(encoded.select(key, "ids"), fields, lambda at, ids: [
        at, None if ids is None else codec(path).decode(ids)])


def round_trip(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """`key`, `ids` and `decoded`, as `encode` and then `decode` give them, in one step."""
    fields = [docs.schema[key], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]

    def both(at, text):
        ids = codec(path).encode(text)
        return [at, ids, codec(path).decode(ids)]

    return _mapped(docs.select(key, "text"), fields, both)


def digests(coded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of ids and the hashes of ids and decoded text, for rows of `round_trip`."""
    return coded.select(
        key, F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
