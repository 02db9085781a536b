"""Benchmark decontamination with a broadcast set of hashed word windows.

Words are runs of digits, letters and every character above U+007F, after A-Z
are lower-cased.  A window is ``SIZE`` consecutive words of a benchmark item;
an item with fewer words, but not none, is one window as a whole.

1. The items are cut into segments (which overlap by ``SIZE - 1`` words, so no
   window is lost) and dealt to parts of about ``PART_WORDS`` words; only one
   part is gathered and broadcast at a time, so the broadcast is bounded
   whatever the benchmark's size.  One part is the common case.
2. The whole text of every document is scanned in one pass per part, without a
   shuffle: a rolling hash of each window of words, a bit table that most
   windows fail, and the sorted hashes of the part.
3. Every hit is verified by comparing the words themselves.

``scan`` reports words, hit words, items and spans of each document;
``cleaned`` removes the spans or the documents.

Defined results: a null or blank text has no words and is clean; rows that
repeat, share an id or have none are each judged on their own; items that share
an id are one item, an item without an id is named by the empty string, one
without words matches nothing; empty tables give an empty result, or clean
documents; further columns pass through ``cleaned`` and are not read else.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize, ship_package
from .batches import pieces_of
from .shingles import mix, word_hashes

SIZE = 10
SEGMENT = 1000
PART_WORDS = 1_000_000
MAX_SHARE = 0.5
BLOCK = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FACTORS = mix(np.arange(1, SIZE + 1, dtype=np.uint64)) | np.uint64(1)
RUN = "array<struct<first:long,last:long>>"
SPAN = "array<struct<start:long,end:long>>"


class Words:
    """The words of texts that lie end to end in ``data`` (lower-cased bytes):
    first byte, end and hash of each, and the words of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        parts = [_words(data, offsets, a, b) for a, b in _slices(data)]
        self.start, self.end, self.hash = (np.concatenate(x) for x in zip(*parts)) if parts else (
            np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))
        self.data, self.offsets, self.bounds = data, offsets, np.searchsorted(self.start, offsets)

    def text(self, first: int, n: int) -> bytes:
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.start[first:first + n], self.end[first:first + n]))

    def windows(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each word on, whatever text they are in."""
        size = max(0, len(self.hash) - n + 1)
        total = np.full(size, n, np.uint64)
        for j in range(n):
            total += self.hash[j:j + size] * _FACTORS[j]
        return mix(total)


def _slices(data: np.ndarray):
    """Ranges of about ``BLOCK`` bytes that end outside words."""
    first = 0
    while first < len(data):
        last = min(first + BLOCK, len(data))
        while last < len(data):
            outside = np.flatnonzero(~_IN_WORD[data[last:last + BLOCK]])
            last = min(last + BLOCK, len(data)) if not len(outside) else last + int(outside[0])
            if len(outside):
                break
        yield first, last
        first = last


def _words(data, offsets, first: int, last: int):
    inside = _IN_WORD[data[first:last]]
    edge = np.zeros(last - first + 1, bool)
    edge[0] = edge[-1] = True
    a, b = np.searchsorted(offsets, (first, last + 1))
    edge[offsets[a:b] - first] = True
    start = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:-1]))
    end = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])) + 1
    return start + first, end + first, word_hashes(data[first:last], start, end)


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, A-Z lower-cased, end to end, and where each begins."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return _LOWER[data], offsets - offsets[0]


def _segments(batches):
    """(item, segment): the words of each item, joined by spaces, cut."""
    for batch in batches:
        items, segments = [], []
        names = batch.column("item").to_pylist()
        words = Words(*lowered(batch.column("text")))
        for name, a, b in zip(names, words.bounds[:-1], words.bounds[1:]):
            for at in range(a, max(a + 1, b - SIZE + 1), SEGMENT) if b > a else ():
                items.append(name)
                segments.append(words.text(at, min(SEGMENT + SIZE - 1, b - at)).decode())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(segments, pa.string())],
                                         names=["item", "segment"])


class Index:
    """Windows of one part of the benchmark, by their length and hash."""

    def __init__(self, segments: pa.Table):
        texts = segments.column("segment").combine_chunks()
        self.items = segments.column("item").to_pylist()
        self.words = Words(*lowered(texts))
        counts = np.diff(self.words.bounds)
        owner = np.repeat(np.arange(len(self.items)), counts)
        self.tables = {}
        for n in np.unique(np.minimum(counts, SIZE)).tolist():
            at = np.concatenate([np.arange(a, b - n + 1) for a, b in zip(self.words.bounds[:-1], self.words.bounds[1:])
                                 if min(b - a, SIZE) == n])
            key = self.words.windows(n)[at]
            order = np.argsort(key, kind="stable")
            size = max(16, int(2 ** math.ceil(math.log2(len(key) * 16 + 1))))
            bits = np.zeros(size, bool)
            bits[key & np.uint64(size - 1)] = True
            self.tables[n] = (key[order], at[order], owner[at[order]], bits)

    def hits(self, words: Words):
        """(first word, words, items) of every verified hit, in no order."""
        text_of = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
        for n, (keys, at, owner, bits) in self.tables.items():
            hashes = words.windows(n)
            possible = np.flatnonzero(bits[hashes & np.uint64(len(bits) - 1)])
            possible = possible[text_of[possible] == text_of[possible + n - 1]]
            low, high = np.searchsorted(keys, hashes[possible], "left"), np.searchsorted(keys, hashes[possible], "right")
            for first, a, b in zip(possible[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                here = words.text(first, n)
                found = {self.items[owner[i]] for i in range(a, b) if self.words.text(int(at[i]), n) == here}
                if found:
                    yield first, n, found


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """First and last position of every run of true values."""
    step = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(step == 1).tolist(), (np.flatnonzero(step == -1) - 1).tolist()))


def _scan(part, passed: list[str], types: pa.Schema, with_text: bool):
    """One part's hits, joined to those of the parts before (columns ``runs``
    and ``items``)."""
    def scan(batches):
        index = part.value
        for batch in (small for whole in batches for small in pieces_of(whole, "text", BLOCK)):
            texts = batch.column("text")
            words = Words(*lowered(texts))
            starts = words.bounds[:-1]
            hit = np.zeros(len(words.start), bool)
            items = [set(x or ()) for x in batch.column("items").to_pylist()]
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                for run in runs or ():
                    hit[starts[i] + run["first"]:starts[i] + run["last"] + 1] = True
            for first, n, found in index.hits(words):
                hit[first:first + n] = True
                items[int(np.searchsorted(words.bounds, first, "right")) - 1] |= found
            out = {"n_words": np.diff(words.bounds).tolist(), "n_hit": [], "runs": [], "spans": [], "rest": [],
                   "items": [sorted(x) for x in items]}
            for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                runs = _runs(hit[a:b]) if hit[a:b].any() else []
                raw = texts[i].as_py().encode() if runs else b""
                base = words.offsets[i]
                edges = [(int(words.start[a + x] - base), int(words.end[a + y] - base)) for x, y in runs]
                out["n_hit"].append(int(hit[a:b].sum()))
                out["runs"].append([{"first": x, "last": y} for x, y in runs])
                out["spans"].append(_code_points(raw, edges))
                out["rest"].append(_without(raw, edges) if runs else texts[i].as_py() if with_text else None)
            columns = [batch.column(name) for name in passed] + [pa.array(out[f.name], f.type) for f in types]
            yield pa.RecordBatch.from_arrays(columns, names=[*passed, *types.names])
    return scan


def _code_points(raw: bytes, edges) -> list[dict]:
    if not edges:
        return []
    before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(before[a]), "end": int(before[b])} for a, b in edges]


def _without(raw: bytes, edges) -> str:
    ends = [0, *(b for _, b in edges)]
    starts = [*(a for a, _ in edges), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends, starts)).decode()


_OUT = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                  ("runs", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("rest", pa.string())])
_DDL = f"n_words long, n_hit long, items array<string>, runs {RUN}, spans {SPAN}, rest string"


def _scanned(docs: DataFrame, benchmark: DataFrame, with_text: bool, part_words: int) -> DataFrame:
    """``docs`` (key, text) with the columns of ``_DDL``."""
    spark = docs.sparkSession
    ship_package(spark)
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    segments = materialize(named.mapInArrow(_segments, "item string, segment string").distinct(), "benchmark")
    # A word is followed by a space, so spaces count words without a pass in Python.
    n_words = segments.agg(F.sum(F.length("segment") - F.length(F.translate("segment", " ", "")) + 1)).first()[0] or 0
    n_bytes = segments.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    parts = max(1, math.ceil(n_words / part_words), math.ceil(n_bytes / (32 * part_words)))
    rows = docs.select("key", "text", F.lit(None).cast(RUN).alias("runs"), F.lit(None).cast("array<string>").alias("items"))
    for p in range(parts):
        if p:
            rows = materialize(rows.select("key", "text", "runs", "items"), "decontamination")
        own = segments.where(F.pmod(F.xxhash64("segment"), F.lit(parts)) == p).toArrow()
        index = spark.sparkContext.broadcast(Index(own))
        last = p == parts - 1
        passed = ["key"] if last else ["key", "text"]
        schema = StructType([docs.schema[c] for c in passed] + StructType.fromDDL(_DDL).fields)
        rows = rows.mapInArrow(_scan(index, passed, _OUT, with_text and last), schema)
    return rows


def scan(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as strings, sorted) and spans (code
    points, end exclusive) of every document."""
    rows = _scanned(docs.select(F.col("doc_id").alias("key"), "text"), benchmark, False, part_words)
    return rows.select(F.col("key").alias("doc_id"), "n_words", "n_hit", "items", "spans")


def cleaned(docs: DataFrame, benchmark: DataFrame, how: str = "spans", max_share: float = MAX_SHARE,
            part_words: int = PART_WORDS) -> DataFrame:
    """``docs`` without contamination.  ``spans``: the spans go from the texts,
    and documents with more than ``max_share`` of their words hit go;
    ``documents``: every document with a hit goes."""
    if how not in ("spans", "documents"):
        raise ValueError(f"how has to be spans or documents, not {how!r}")
    others = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != "text"]
    rows = _scanned(docs.select(F.struct(*others, F.lit(0).alias("_")).alias("key"), "text"), benchmark, True, part_words)
    kept = rows.where("n_hit = 0" if how == "documents" else F.col("n_hit") <= F.col("n_words") * max_share)
    return kept.select(*(F.col("rest").alias(c) if c == "text" else F.col("key")[c].alias(c) for c in docs.columns))
