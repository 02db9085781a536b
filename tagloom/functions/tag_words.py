"""The tokeniser of ``functions.text`` for strings of settled letters, inside Arrow
tasks: words and short lines repeat, so what a task has seen is kept (bounded).

Every step has the name and the rules of its expression there, and gives the same
result.  A string with any other character (not in ``_RANGES``: scripts whose case and
marks are the same in every Unicode version in use; no line ends) gives ``None``
and takes the expressions.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import constants as C
from . import text as X

# ASCII without line ends, Latin, Greek, Cyrillic, kana, unified ideographs, Hangul.
_RANGES = [("\x00", "\x09"), ("\x0b", "\x0c"), ("\x0e", "\x7f"), ("\xa0", "\u024f"), ("\u0386", "\u03ce"), ("\u0400", "\u04ff"),
           ("\u3041", "\u3096"), ("\u30a1", "\u30fe"), ("\u4e00", "\u9fa5"), (C.HANGUL_FIRST, C.HANGUL_LAST)]
# Words and lines kept by a worker; a kept line has at most this many characters.
KEPT, KEPT_LINE = 200_000, 64

_plain = re.compile("([a-z]{2,})\\.?").fullmatch
_uncountable = re.compile(X._uncountable_pattern())
_digit_or_colon = re.compile("[0-9:;]").search
_SPACES = str.maketrans(dict.fromkeys(C.PUNCTUATION + X._JAVA_SPACE_CHARS, " "))
# Ends of what the rules with '$' match (see ``text._NOT_S``).
_ENDINGS = ("s", "en", "eople", "ice", "ta", "ia", "i")
# Starts of what the rules with '^' match, if the line has no digit, ':', ';' or 'canon'.
_beginning = re.compile(r"[a-z]+[.\-]|\.+[a-z]|-+[a-z]|" + X._SINGULAR_START).match
# Characters of lines that are taken apart at a time.
_AT_ONCE = 1 << 23
# No pattern with '$' reaches further back than this.
_TAIL = 16


def _python(replacement: str) -> str:
    return re.sub(r"\$(\d)", r"\\g<\1>", replacement)


_SINGULAR = [(re.compile(p), _python(r), p.endswith("$")) for p, r in C.SINGULAR_RULES]
_REWRITE = [(re.compile(p).fullmatch, {C.DOT_TO_SPACE: ".", C.DASH_TO_SPACE: "-"}.get(r), _python(r)) for _, p, r in C.REWRITE_RULES]


@functools.lru_cache(maxsize=1)
def _folded_letters() -> dict[str, str]:
    """What every settled character becomes; none of it is folded any further."""
    return {chr(cp): "".join(c for c in unicodedata.normalize("NFD", chr(cp)) if not C._is_stripped_mark(c))
            for a, b in _RANGES for cp in range(ord(a), ord(b) + 1)}


@functools.lru_cache(maxsize=1)
def _folding() -> tuple:
    """(search for a character that is not settled, table of the letters that change)."""
    letters = _folded_letters()
    kept = "".join(f"{re.escape(a)}-{re.escape(b)}" for a, b in _RANGES)
    return re.compile(f"[^{kept}\n\r]").search, {ord(c): to for c, to in letters.items() if c != to}


def fold(x: str) -> str | None:
    low = x.strip(X._CONTROL_AND_SPACE).lower()
    if not low.isascii():
        unsettled, table = _folding()
        if unsettled(low):
            return None
        low = low.translate(table)
    return None if "\n" in low or "\r" in low else low.replace("^", "").replace("`", "")


def singular(s: str) -> str:
    if not (s.endswith(_ENDINGS) or s.startswith(X._SINGULAR_START)):
        return s
    tail = max(0, len(s) - _TAIL)
    if _uncountable.search(s, tail):
        return s
    for pattern, repl, at_end in _SINGULAR:
        if pattern.search(s, tail if at_end else 0):
            return pattern.sub(repl, s)
    return s


def rewrite_split(s: str) -> list[str]:
    for full, spaced, repl in (_REWRITE if "canon" in s or _digit_or_colon(s) else _REWRITE[X._REWRITE_GUARDED:]):
        m = full(s)
        if m:
            s = s.replace(spaced, " ") if spaced else m.expand(repl)
            break
    s = s.replace("&amp;", "&").translate(_SPACES).replace("..", "").replace("--", "-")
    s = "b&w" if s == "bw" else s
    return [w for w in s.strip(X._CONTROL_AND_SPACE).split(" ") if len(w) > 1]


def line_words(x: str) -> list[str] | None:
    s = fold(x)
    return None if s is None else rewrite_split(singular(s))


def expand(x: str) -> list[tuple[str, bool]] | None:
    words = line_words(x)
    if words is None:
        return None
    if len(words) == 1:
        if words[0] == x:
            return [(x, True)]
        words = rewrite_split(words[0])
    return [(w, False) for w in words]


@functools.lru_cache(maxsize=KEPT)
def tokens(x: str) -> tuple[str, ...] | None:
    """T(x); ``None`` as well if it were unfinished after the rounds allowed."""
    plain = _plain(x)
    if plain and (w := plain[1]) != "bw" and "canon" not in w:  # as in text.tokens: only the singular rules matter
        s = singular(w)
        if s == w or len(s) > 1 and s != "bw" and "canon" not in s and singular(s) == s:
            return (s,)
    state = [(x, False)]
    for _ in range(2 * len(x) + 8):
        if all(done for _, done in state):
            return tuple(s for s, _ in state)
        parts = [[(s, True)] if done else expand(s) for s, done in state]
        if None in parts:
            return None
        state = [entry for part in parts for entry in part]
    return tuple(s for s, _ in state) if all(done for _, done in state) else None


def line_tokens(x: str) -> list[str] | None:
    children = expand(x)
    if children is None:
        return None
    out = {}
    for word in dict.fromkeys(s for s, _ in children):
        found = tokens(word)
        if found is None:
            return None
        out.update(dict.fromkeys(found))
    return list(out)


def _joined_words(x: str) -> str | None:
    words = line_words(x)
    return None if words is None else " ".join(words)


_short_line_tokens = functools.lru_cache(maxsize=KEPT)(line_tokens)
_short_joined_words = functools.lru_cache(maxsize=KEPT)(_joined_words)


# What a part of a line (between two spaces) tells: the whole line takes the rules
# anyway, if it begins with the part, or if it ends with it.
_ANYWHERE, _FIRST, _LAST = 1, 2, 4


@functools.lru_cache(maxsize=KEPT)
def line_part(c: str) -> tuple[int, int, tuple[str, ...]]:
    """(where it keeps the line's rules from being skipped, words, their tokens)."""
    s = fold(c)
    if s is None or "canon" in s or _digit_or_colon(s):
        return _ANYWHERE, 0, ()
    words = [w for w in s.translate(_SPACES).replace("..", "").replace("--", "-").split(" ") if len(w) > 1]
    found = [tokens(w) for w in words]
    if None in found:
        return _ANYWHERE, 0, ()
    return (_FIRST if _beginning(s) else 0) | (_LAST if s.endswith(_ENDINGS) else 0), len(words), tuple(t for ts in found for t in ts)


# Parts that are one word of letters, perhaps with a final mark; what a singular
# rule or a rewrite may change in a word; and an 's' that only the last rule takes.
_LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]{2,}[.,]?$"
_CHANGING = "(s|men|hildren|people|ice|[ti]a|[pr]i)$|^oxen|canon|^bw$"
_LAST_RULE = "([^aeiuws]|[^vxzcohsi]e)s$"
_OTHER_RULE = "testes$|^jeans$|^oxen|canon"


def _matches(a: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(a, pattern).to_numpy(zero_copy_only=False)


def plain_parts(parts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(place, token) of the parts that are one word with itself, or itself without
    an 's', as its only token."""
    place = np.flatnonzero(_matches(parts, _LETTERS))
    low = pc.utf8_lower(parts.take(pa.array(place)))
    marked = ~pc.string_is_ascii(low).to_numpy(zero_copy_only=False)
    if marked.any():
        bare = pc.replace_substring_regex(pc.utf8_normalize(low.filter(pa.array(marked)), "NFD"), "[\u0300-\u036f]", "")
        low = pc.replace_with_mask(low, pa.array(marked), bare)
    word = pc.utf8_rtrim(low, ".,")
    ends = _matches(word, _LAST_RULE) & ~_matches(word, _OTHER_RULE)
    word = pc.if_else(pa.array(ends), pc.utf8_slice_codeunits(word, 0, -1), word)
    keep = _matches(word, "^[a-z]{2,}$") & ~_matches(word, _CHANGING)
    return place[keep], word.filter(pa.array(keep))


def _looked_up(parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """``line_part`` of every part: flags, words, tokens, and these one after another."""
    place, word = plain_parts(parts)
    flags, n_words, n_tokens = (np.zeros(len(parts), np.int64) for _ in range(3))
    n_words[place] = n_tokens[place] = 1
    flags[_matches(parts, "\\.$")] = _FIRST
    flags[_matches(parts, "([SNEAIsneai]|[^\\x00-\\x7f])$")] = _LAST
    other = np.ones(len(parts), bool)
    other[place] = False
    other = np.flatnonzero(other)
    known = [line_part(c) for c in parts.take(pa.array(other)).to_pylist()]
    for out, of in ((flags, [k[0] for k in known]), (n_words, [k[1] for k in known]), (n_tokens, [len(k[2]) for k in known])):
        out[other] = of
    words = pa.concat_arrays([word, pa.array([t for k in known for t in k[2]], pa.string())])
    of = np.concatenate([place, np.repeat(other, n_tokens[other])])
    return flags, n_words, n_tokens, words.take(pa.array(np.argsort(of, kind="stable")))


def _tokens_of(labels: pa.Array) -> pa.Array:
    """Lines are cut at their spaces, and every distinct part is looked up once.  No
    rule for whole lines reaches beyond the first or last part, or else a part
    shows that one may apply; such a line, one of fewer than two words or one with a
    control character is taken as a whole."""
    n = len(labels)
    parts = pc.split_pattern(labels, " ")
    parent = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    coded = pc.list_flatten(parts).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    flags, n_words, n_tokens, token = _looked_up(coded.dictionary)
    token = token.dictionary_encode()

    whole = pc.fill_null(pc.match_substring_regex(labels, "[\\x00-\\x1f]"), False).to_numpy(zero_copy_only=False).copy()
    whole |= np.bincount(parent, n_words[code], n) < 2
    filled = np.flatnonzero(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[code] > 0)
    change = np.flatnonzero(np.diff(parent[filled]))
    ends = np.concatenate([filled[change], filled[-1:]])
    begins = np.concatenate([filled[:1], filled[change + 1]])
    for at, flag in ((slice(None), _ANYWHERE), (begins, _FIRST), (ends, _LAST)):
        whole[parent[at][flags[code[at]] & flag > 0]] = True

    use = ~whole[parent]
    code, parent = code[use], parent[use]
    times = n_tokens[code]
    line = np.repeat(parent, times)
    begin = np.cumsum(n_tokens) - n_tokens
    place = np.arange(len(line)) + np.repeat(begin[code] - (np.cumsum(times) - times), times)
    value = token.indices.to_numpy(zero_copy_only=False)[place].astype(np.int64)
    first = np.sort(np.unique(line * (len(token.dictionary) + 1) + value, return_index=True)[1])
    line, value, values = line[first], value[first], token.dictionary

    null = labels.is_null().to_numpy(zero_copy_only=False).copy()
    at = np.flatnonzero(whole & ~null)
    if len(at):
        own = [line_tokens(x) if len(x) > KEPT_LINE else _short_line_tokens(x) for x in labels.take(pa.array(at)).to_pylist()]
        null[at[[x is None for x in own]]] = True
        own = [x or [] for x in own]
        line = np.concatenate([line, np.repeat(at, [len(x) for x in own])])
        order = np.argsort(line, kind="stable")
        line, value = line[order], np.concatenate([value, len(values) + np.arange(len(line) - len(value))])[order]
        values = pa.concat_arrays([values, pa.array([t for x in own for t in x], pa.string())])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values.take(pa.array(value)), mask=pa.array(null))


def tokens_of_lines(labels: pa.Array) -> pa.Array:
    """Distinct tokens of every line, in order; null if it has unsettled characters."""
    size = np.cumsum(pc.fill_null(pc.binary_length(labels), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(size // _AT_ONCE)) + 1), len(labels)]
    return pa.concat_arrays([_tokens_of(labels.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])


def words_of_lines(labels: pa.Array) -> pa.Array:
    return pa.array([None if x is None else _short_joined_words(x) if len(x) <= KEPT_LINE else _joined_words(x)
                     for x in labels.to_pylist()], pa.string())
