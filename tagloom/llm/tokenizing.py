"""Exact token ids and counts of whole texts, one library call per new piece.

A tokenizer never joins characters across certain white space, so a text can
be cut there and every piece looked up in a table of the pieces met before;
the library encodes only new pieces.  Texts for which the cut is not provably
the same (control separators, special strings) go to the library whole.  The
tables belong to a Python worker and start anew beyond ``MAX_PIECES`` entries,
so memory is bounded; they change speed, never results.
"""

from __future__ import annotations

import functools
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .shingles import word_hashes

MAX_PIECES = 150_000
MAX_PARTS = 1_000_000
_CONTROLS = "\\x1c-\\x1f\\u180e\\u200b-\\u200d\\u2060\\ufeff"
# White space other than one space or one newline between words, controls that
# libraries class differently; special strings start with ``_SPECIAL``.
_ODD_SPACE = re.compile("[ \\n][ \\n]|<\\||[\\t\\r\\x0b\\x0c\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000" + _CONTROLS + "]")
_CONTROL = re.compile("[" + _CONTROLS + "]")
_SPECIAL = "<|"
# Texts with any of these are not cut at ASCII white space by Arrow.
_NOT_PLAIN = "<\\||[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200d}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{2060}\\x{3000}\\x{feff}]"


_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[!-~{_LETTERS}]+")
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^a-z0-9{_LETTERS}]+")
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# Byte-level vocabularies write a byte that is no visible Latin-1 character as
# the next free code point from 256 on.
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


# Words of these code points alone are cut into their parts by Arrow: letters,
# runs of marks, single digits.
_CUT = f"^[!-&(-~{_LETTERS}]+$"
_MARKS = f"([^a-z0-9{_LETTERS} ]+)"
_DIGIT = "([0-9])"


_MIXED = np.random.default_rng(9).permutation(256).astype(np.uint8)


def _joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(p) // 4 for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), "<u4"), np.cumsum(size) - size


def _appended(ids, first, size, pieces: list[bytes]):
    more, starts = _joined(pieces)
    return (np.concatenate([ids, more]), np.concatenate([first, starts + len(ids)]),
            np.concatenate([size, np.array([len(p) // 4 for p in pieces], np.int64)]))


def _gathered(ids, first, size, order) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces in ``order``, and where each one ends."""
    lengths = size[order]
    total = np.cumsum(lengths)
    where = np.repeat(first[order] - (total - lengths), lengths) + np.arange(total[-1] if len(total) else 0)
    return ids[where], total


class _PartTable:
    """Ids of the parts met before, by a 128-bit hash of their bytes: three sorted
    columns and one run of ids, some 40 bytes a part.  Beyond ``MAX_PARTS`` it
    starts anew."""

    def __init__(self, compute):
        self.compute = compute
        self._clear()

    def _clear(self):
        self.a, self.b = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.first, self.size, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")

    def _find(self, a, b):
        if not len(self.a):
            return np.zeros(len(a), np.int64), np.zeros(len(a), bool)
        order, at = np.argsort(a), np.empty(len(a), np.int64)  # sorted questions are answered faster
        at[order] = np.minimum(np.searchsorted(self.a, a[order]), len(self.a) - 1)
        return at, (self.a[at] == a) & (self.b[at] == b)

    def get(self, parts: pa.Array):
        """Distinct parts -> where the ids of each begin in ``ids``, and how many they are."""
        parts = parts.cast(pa.large_string())
        offsets = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset:parts.offset + len(parts) + 1]
        data = np.frombuffer(parts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        a, b = (word_hashes(x, start, end) if len(data) else np.zeros(len(parts), np.uint64) for x in (data, _MIXED[data]))
        at, known = self._find(a, b)
        if not known.all():
            if len(self.a) + len(a) > MAX_PARTS:
                self._clear()
                known[:] = False
            new = np.flatnonzero(~known)
            more, starts = _joined([self.compute(p) if p else b"" for p in parts.take(pa.array(new)).to_pylist()])
            sizes = np.diff(np.append(starts, len(more)))
            order = np.argsort(a[new], kind="stable")
            place = np.searchsorted(self.a, a[new][order])
            self.first = np.insert(self.first, place, (starts + len(self.ids))[order])
            self.size = np.insert(self.size, place, sizes[order])
            self.b = np.insert(self.b, place, b[new][order])
            self.a = np.insert(self.a, place, a[new][order])
            self.ids = np.concatenate([self.ids, more])
            at, known = self._find(a, b)
        first, size = self.first[at], self.size[at]
        for i in np.flatnonzero(~known).tolist():  # another part has the first hash
            own = np.frombuffer(self.compute(parts[i].as_py()), "<u4")
            first[i], size[i] = len(self.ids), len(own)
            self.ids = np.concatenate([self.ids, own])
        return first, size


class _Table(dict):
    """Piece -> value, computed where it is missing.  Beyond ``MAX_PIECES`` the
    entries become the old generation, from which those met again come back."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, piece):
        if len(self) >= MAX_PIECES:
            self.old = dict(self)
            self.clear()
        value = self.old.get(piece)
        value = self[piece] = self.compute(piece) if value is None else value
        return value


def _packed(*ids: int) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class TokenCounter:
    """Token counts of a byte-level tokenizer, which splits words before the
    one space in front of them and takes a newline before a word alone."""

    def __init__(self, definition: str):
        self.library = Tokenizer.from_str(definition)
        self.table = _Table(lambda p: self.whole(p if p.startswith("\n") else " " + p))

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        if _SPECIAL in text or _ODD_SPACE.search(text):
            return self.whole(text)
        pieces = text.replace("\n", " \n").split(" ")
        first = self.whole(pieces[0]) if pieces[0] else 0
        return first + sum(map(self.table.__getitem__, pieces[1:]))


class TokenIds:
    """Ids, as little-endian unsigned 32-bit bytes, of a tokenizer that drops
    white space, lower-cases, and encodes runs of letters, single digits and
    runs of other marks (``_PARTS``) on their own.  Pieces of ASCII and Latin-1
    letters only are cut into these parts, which go straight to the model."""

    def __init__(self, definition: str):
        self.library = Tokenizer.from_str(definition)
        self.model = self.library.model
        self.parts = _Table(self.part)
        self.known_parts = _PartTable(self.part)
        self.table = _Table(self.piece)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, part: str) -> bytes:
        """One part: its bytes, written as the model's vocabulary writes them."""
        name = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_NAMES)
        return _packed(*[t.id for t in self.model.tokenize(name)])

    def piece(self, piece: str) -> bytes:
        if not _PLAIN.fullmatch(piece):
            return self.whole(piece)
        return b"".join(map(self.parts.__getitem__, _PARTS.findall(piece.lower())))

    def of_batch(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, one behind the other, and
        where each text begins.  Words that are met again in the batch, and parts
        that are met again in its words, are looked up once and gathered."""
        texts = texts.cast(pa.large_string())
        odd = pc.match_substring_regex(texts, _NOT_PLAIN).to_numpy(zero_copy_only=False)
        words = pc.ascii_split_whitespace(pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts))
        flat = words.flatten().dictionary_encode()
        ids, first, size = self._of_words(flat.dictionary)
        more = [*(self.whole_ids(t) for t in texts.filter(pa.array(odd)).to_pylist()), np.array([end], "<u4").tobytes()]
        ids, first, size = _appended(ids, first, size, more)
        # The words of each text, or the one entry of an odd one, then the end.
        ends = np.cumsum(np.diff(words.offsets.to_numpy()) + 1) - 1
        order = np.full(len(flat) + len(texts), len(size) - 1, np.int64)
        inner = np.ones(len(order), bool)
        inner[ends] = False
        order[inner] = flat.indices.to_numpy()
        order[ends[odd] - 1] = len(flat.dictionary) + np.arange(len(more) - 1)
        out, total = _gathered(ids, first, size, order)
        return out, np.concatenate([[0], total[ends]])

    def _of_words(self, words: pa.Array):
        """Distinct words -> all their ids, and where each word's begin and how many they are."""
        plain = pc.match_substring_regex(words, _CUT)
        cut = pc.utf8_lower(words.filter(plain))
        for pattern in (_MARKS, _DIGIT):
            cut = pc.replace_substring_regex(cut, pattern, " \\1 ")
        parts = pc.ascii_split_whitespace(pc.ascii_trim(cut, " "))
        flat = parts.flatten().dictionary_encode()
        starts, sizes = self.known_parts.get(flat.dictionary)
        ids, total = _gathered(self.known_parts.ids, starts, sizes, flat.indices.to_numpy())
        bounds = np.concatenate([[0], total])[parts.offsets.to_numpy()]
        plain = plain.to_numpy(zero_copy_only=False)
        first, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        first[plain], size[plain] = bounds[:-1], np.diff(bounds)
        # An empty string stands before, between and behind white space.
        others = [self.table[w] if w else b"" for w in words.filter(pa.array(~plain)).to_pylist()]
        at = len(ids)
        ids, all_first, all_size = _appended(ids, first[:0], size[:0], others)
        first[~plain], size[~plain] = all_first, all_size
        return ids, first, size

    def whole_ids(self, text: str) -> bytes:
        return self.ids(text).tobytes()

    def ids(self, text: str) -> np.ndarray:
        raw = self.whole(text) if _SPECIAL in text or _CONTROL.search(text) else b"".join(map(self.table.__getitem__, text.split()))
        return np.frombuffer(raw, dtype="<u4")


@functools.lru_cache(maxsize=4)
def token_counter(definition: str) -> TokenCounter:
    """One counter per Python worker, so that its table outlives a task."""
    return TokenCounter(definition)


@functools.lru_cache(maxsize=4)
def token_ids(definition: str) -> TokenIds:
    return TokenIds(definition)


def read_definition(path: str) -> str:
    """The tokenizer file as text (read on the driver, sent with the tasks:
    its size is fixed)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
