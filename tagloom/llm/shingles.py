"""Hashed word shingles of whole Arrow batches, computed on the UTF-8 bytes.

A word is a run of other bytes than space and U+0009..U+000D, lower-cased; a
shingle is five words in a row.  A text of one to four words has one shingle of
all of them; a text without a word has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SIZE = 5
BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to its end."""
    power, inverse = _powers(len(data) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], dtype=np.uint64)])
    return mix((total[end] - total[start]) * inverse[start])


def _words(data: np.ndarray, starts_of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of the concatenated texts."""
    n = len(data)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[starts_of_text] = edge[n] = True
    before = np.concatenate([[True], space[:-1]]) | edge[:-1]
    after = np.concatenate([space[1:], [True]]) | edge[1:]
    start, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    return word_hashes(data, start, end), start


def _blocks(texts: pa.Array):
    """(first text, offsets, bytes) of parts of about ``BLOCK`` bytes."""
    lower = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    if not len(lower):
        return
    offsets = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset:lower.offset + len(lower) + 1]
    data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(lower):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK)))
        last = min(last, len(lower))
        yield first, offsets[first:last + 1] - offsets[first], data[offsets[first]:offsets[last]]
        first = last


def shingled(texts: pa.Array):
    """For each text in turn: its word hashes and its shingle hashes, in order."""
    for _, offsets, data in _blocks(texts):
        words, at = _words(data, offsets[:-1]) if len(data) else (np.empty(0, np.uint64), np.empty(0, np.int64))
        bounds = np.searchsorted(at, offsets)
        sums = _window_sums(words)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= SIZE:
                yield words[a:b], mix(sums[a:b - SIZE + 1])
            elif b > a:
                yield words[a:b], mix(_fold(words[a:b])[None] + np.uint64(b - a))
            else:
                yield words[:0], words[:0]


def _window_sums(words: np.ndarray) -> np.ndarray:
    n = max(0, len(words) - SIZE + 1)
    return sum((words[j:j + n] * np.uint64(2 * j + 0x632BE59BD9B4E019) for j in range(SIZE)), np.zeros(n, np.uint64))


def _fold(words: np.ndarray) -> np.uint64:
    """Order-dependent hash of a run of words."""
    power, _ = _powers(len(words) + 1)
    return (words * power[:len(words)]).sum(dtype=np.uint64)


def digest(words: np.ndarray) -> tuple[int, int]:
    """128 bits of a text's words, as two signed longs."""
    a = mix(np.array([_fold(words) + np.uint64(len(words))], np.uint64))
    b = mix(np.array([_fold(mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5))) ^ np.uint64(len(words))], np.uint64))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])
