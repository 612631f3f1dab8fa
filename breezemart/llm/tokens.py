"""Token ids of whole texts, word by word through a bounded cache."""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries and bytes of a worker's cache, the longest word it holds, and the bytes of texts that are looked
#: up at once, unless one text has more; they bound its memory. What an entry takes besides its word and ids.
CACHE_WORDS, CACHE_BYTES, CACHE_CHARS, SLICE, ENTRY = 900_000, 64 << 20, 40, 4 << 20, 80
#: Bytes of texts that are cut into pieces at once, unless one text has more.
CUT_AT_ONCE = 256 << 10
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch

#: What a byte is: a space, of a Latin letter, a digit, ASCII punctuation but the apostrophe, a line end, or
#: else. More bits: white space of ASCII, and the first byte of a character that may be other white space.
SPACE, LETTER, DIGIT, SIGN, LINE, ELSE, BLANK, LEAD = 0, 1, 2, 3, 4, 5, 8, 16


def _kind(byte: int) -> int:
    char = chr(byte)
    if byte in (0xC2, 0xE1, 0xE2, 0xE3):
        return ELSE | LEAD
    if 0x80 <= byte <= 0xBF or 0xC3 <= byte <= 0xC9 or char.isascii() and char.isalpha():
        return LETTER
    if byte in b" \n":
        return BLANK | (SPACE if byte == 32 else LINE)
    if char.isascii() and char.isspace():
        return ELSE | BLANK
    return DIGIT if byte in b"0123456789" else SIGN if 32 < byte < 127 and char != "'" else ELSE


KINDS = bytes(map(_kind, range(256)))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _clean(word: str) -> bool:
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


def _cut(piece: str) -> list[str]:
    """Parts of a space and a word that the byte-level pre-tokenizer always keeps apart: lines, and
    Latin letters from the ASCII punctuation after them (an apostrophe can belong to letters)."""
    if plain := _PLAIN(piece, 1):
        body, tail = plain.groups()
        return [" " + body, tail] if tail else [piece]
    lines = piece[1:].split("\n")
    if len(lines) == 1 or not all(map(_clean, lines)):
        return [piece]
    parts = _cut(" " + lines[0])
    for line in lines[1:]:
        plain = _PLAIN(line)
        parts += ["\n", *([x for x in plain.groups() if x] if plain else [line])]
    return parts


def _blanks(raw: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space, as str.isspace has it."""
    blank = (kinds & BLANK) != 0
    leads = np.flatnonzero(kinds & LEAD)
    if len(leads):
        one, two, three = raw[leads], raw[leads + 1], raw[np.minimum(leads + 2, len(raw) - 1)]
        short = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
        long = (one == 0xE2) & (two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))
        for char in "\u1680\u205f\u3000":
            x, y, z = char.encode()
            long |= (one == x) & (two == y) & (three == z)
        for found, n in ((short, 2), (long, 3)):
            for k in range(n):
                blank[leads[found] + k] = True
    return blank


def _pieces(data: bytes, edges: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of texts start in their joined bytes, and which are not plain.

    A text is cut at single spaces between two non-spaces, which stay with the word after them. A word
    of Latin letters, ASCII digits, ASCII punctuation but the apostrophe, and line ends between two
    non-spaces is plain. The pre-tokenizer keeps its runs of one kind apart, and so they are pieces.
    Other words, and texts that are to be kept `whole`, are a piece each.
    """
    raw, kinds, n = np.frombuffer(data, np.uint8), np.frombuffer(data.translate(KINDS), np.uint8), len(data)
    blank, first = _blanks(raw, kinds), np.zeros(n + 1, bool)
    first[edges] = True
    near = first[:-1] | first[1:]  # beside white space or the end of a text
    near[1:] |= blank[:-1]
    near[:-1] |= blank[1:]
    spaces, kinds = raw == 32, kinds & 7
    odd = (kinds == ELSE) | ((spaces | (raw == 10)) & near)
    before, after = raw[:-1], raw[1:]
    odd[1:] |= (before == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (before == 0xC9) & (after >= 0x90)
    words = spaces & ~near | first[:-1]
    for r in np.flatnonzero(whole):
        words[edges[r] + 1:edges[r + 1]] = False
        odd[edges[r]] = True
    begins = words.copy()
    begins[1:] |= (kinds[1:] != kinds[:-1]) & (kinds[:-1] != SPACE)
    at, starts = np.flatnonzero(begins), np.flatnonzero(words)
    odds = np.concatenate([[0], np.cumsum(odd, dtype=np.int32)])
    strange = (odds[np.append(starts[1:], n)] > odds[starts])
    begun = words[at]
    strange = strange[np.cumsum(begun) - 1]
    kept = begun | ~strange
    return at[kept].astype(np.int32), strange[kept]


def _groups(ends: np.ndarray, size: int) -> list[int]:
    """Texts that end at `ends` in groups of `size` bytes, or of one text: where each starts, and the end."""
    return [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), len(ends)]


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers, equal to those of the whole text.

    Many texts are cut at once into pieces that the byte-level pre-tokenizer keeps apart (`_pieces`).
    Arrow finds the distinct ones and puts the ids together; each is encoded once per worker, while
    the cache holds it. A text that holds an added token of the file, such as <|endoftext|>, is
    encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        symbols = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {c: symbols(c)[0][0] for c in map(chr, [10, *range(32, 127), *range(0xC0, 0x250)])}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}  # ids of plain pieces
        self.parts: dict[str, bytes] = {}  # ids of other pieces, and of their parts
        self.held = 0  # bytes of both
        self.line_end = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def _keep(self, cache: dict[str, bytes], found: dict[str, bytes]) -> None:
        short = {p: ids for p, ids in found.items() if len(p) <= CACHE_CHARS}
        cache |= short
        self.held += sum(map(sys.getsizeof, short)) + sum(map(sys.getsizeof, short.values())) + ENTRY * len(short)

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """Encode parts in one call, a line each: a line end between two non-spaces is an id of its
        own, and so is one before a space and a non-space."""
        plain = [p for p in parts if "\n" not in p and not p[-1].isspace() and not p[:2].isspace()]
        ids = np.frombuffer(self._whole("\n".join(plain)), "<u4")
        ends = np.flatnonzero(ids == np.frombuffer(self.line_end, "<u4")[0])
        found = {}
        if len(self.line_end) == 4 and len(ends) == len(plain) - 1:
            raw, edges = ids.tobytes(), [-1, *ends.tolist(), len(ids)]
            found = {p: raw[4 * a + 4:4 * b] for p, a, b in zip(plain, edges, edges[1:])}
        return found | {p: self._whole(p) for p in parts if p not in found}

    def _plain(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of plain pieces: the pre-tokenizer leaves such a piece whole, so the file's model gets
        it at once, its bytes spelt as the pre-tokenizer does."""
        space, spell, tokenize, found = self.spelt[" "], self.spelt.__getitem__, self.model.tokenize, {}
        for p in pieces:
            spelt = p.replace(" ", space) if p.isascii() and p != "\n" else "".join(map(spell, p))
            found[p] = array("I", [t.id for t in tokenize(spelt)]).tobytes()
        self._keep(self.words, found)
        return found

    def _other(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of other pieces. A piece is kept whole or by its parts, not both."""
        found = {p: self._whole(p) for p in pieces if any(token in p for token in self.added)}
        cuts = {p: _cut(p) if p[0] == " " else [p] for p in pieces if p not in found}
        parts = {part for cut in cuts.values() for part in cut}
        ids = {p: self.parts[p] for p in parts if p in self.parts}
        new = [p for p in parts if p not in ids]
        learnt = self._learn(new) if new else {}
        ids |= learnt
        kept = {}
        for p, cut in cuts.items():
            found[p] = b"".join([ids[part] for part in cut])
            if "\n" not in p and _clean(p.removeprefix(" ")):
                kept[p] = found[p]
        self._keep(self.parts, learnt | kept)
        return found

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all(pa.array([text], pa.string())))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; a null one has none."""
        texts = texts.cast(pa.string()).fill_null("")
        edges = _groups(np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), SLICE)
        for a, b in zip(edges, edges[1:]):
            yield from self._encode(texts.slice(a, b - a))

    def _encode(self, texts: pa.Array) -> Iterator[bytes]:
        if not len(texts):
            return
        if self.held > CACHE_BYTES or len(self.words) + len(self.parts) > CACHE_WORDS:
            self.words.clear()
            self.parts.clear()
            self.held = 0
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:][:len(texts) + 1]
        data = bytes(memoryview(texts.buffers()[2] or b"")[ends[0]:ends[-1]])
        edges = ends - ends[0]
        groups = _groups(edges[1:], CUT_AT_ONCE)
        cut = [_pieces(data[edges[a]:edges[b]], edges[a:b + 1] - edges[a], whole[a:b]) for a, b in zip(groups, groups[1:])]
        starts = np.concatenate([found + edges[a] for a, (found, _) in zip(groups, cut)])
        strange = np.concatenate([odd for _, odd in cut])
        coded = pa.StringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, edges[-1:])), pa.py_buffer(data)).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        other = np.zeros(len(coded.dictionary), bool)
        other[at[strange]] = True
        # one decoded string cut up is several times faster than one object made after another
        joined = pa.ListArray.from_arrays(pa.array([0, len(other)], pa.int32()), coded.dictionary)
        names = pc.binary_join(joined, "\0")[0].as_py().split("\0")
        if len(names) != len(other):
            names = coded.dictionary.to_pylist()

        ids = list(map(self.words.get, names))
        for i in np.flatnonzero(other).tolist():
            ids[i] = self.parts.get(names[i])
        plain = [p for p, x, odd in zip(names, ids, other.tolist()) if x is None and not odd]
        rest = [names[i] for i in np.flatnonzero(other).tolist() if ids[i] is None]
        if plain or rest:
            known = self._plain(plain) | (self._other(rest) if rest else {})
            ids = [known[p] if x is None else x for p, x in zip(names, ids)]
        taken = pa.array(ids, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[np.searchsorted(starts, edges)].tolist() if len(ids) else [0] * len(edges)
        raw = memoryview(taken.buffers()[2] or b"")
        for a, b in zip(ends, ends[1:]):
            yield bytes(raw[a:b])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
