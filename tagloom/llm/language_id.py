"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by stochastic gradient descent in numpy.

A text is lower-cased; everything but letters becomes a boundary between
words.  Its features are the letter n-grams of ``ORDERS`` within words,
boundaries included, hashed into ``BUCKETS`` rows of an embedding table.  The
mean of their rows, times a matrix, gives the logits.  As both steps are
linear, prediction sums one precomputed row of logits per n-gram.

Training takes whole texts of ``PER_LANGUAGE`` documents of each language
(chosen by a hash of the id; documented bound) cut into segments of
``SEGMENT`` characters, at most ``MAX_SEGMENTS`` a language.  Every fifth
document is kept for calibration: a temperature is fitted to its segments, and
the score below which a prediction is not ``accepted`` is the smallest that
keeps the accepted ones ``PRECISION`` right.

Every text is predicted whole, in one pass without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and not accepted; if nothing could be learned every text is; ties go to the
smaller language code; repeated rows are predicted each; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
DIMENSION = 16
PER_LANGUAGE = 400
SEGMENT = 300
SEGMENTS = 8
EPOCHS = 4
RATE = 2.0
PRECISION = 0.99
CHUNK = 1 << 20
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if unicodedata.category(c)[0] == "L":
            low = c.lower()
            table[cp] = ord(low[0])
    return table


def grams(text: str) -> np.ndarray:
    """Bucket of every n-gram of the text (empty if it has no letter)."""
    x = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    x = np.concatenate([[0], x, [0]]).astype(np.uint64)
    x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
    if len(x) < 3:
        return np.empty(0, np.int64)
    inside, h, out = np.ones(len(x), bool), x, []
    for n in range(2, max(ORDERS) + 1):
        # Only the first and the last character of an n-gram may be a boundary.
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[n - 1:]
        inside = inside[:-1] & (x[n - 2:-1] != 0) if n > 2 else inside[:-1]
        if n in ORDERS:
            mixed = h[inside] * np.uint64(0xD6E8FEB86659FD93)
            out.append((mixed >> np.uint64(40)) % np.uint64(BUCKETS))
    return np.concatenate(out).astype(np.int64)


def chunks(text: str):
    """The text in parts of about ``CHUNK`` characters, cut at spaces."""
    start = 0
    while start < len(text):
        end = min(len(text), start + CHUNK)
        if end < len(text):
            end = max(text.rfind(" ", start, end), 0) + 1 if " " in text[start:end] else end
        yield text[start:end]
        start = end


class Model:
    def __init__(self, languages: list[str], table: np.ndarray, temperature: float, threshold: float):
        self.languages, self.table, self.temperature, self.threshold = languages, table, temperature, threshold

    def logits(self, text: str) -> np.ndarray | None:
        total, n = 0.0, 0
        for part in chunks(text):
            g = grams(part)
            total, n = total + self.table[g].sum(axis=0, dtype=np.float64), n + len(g)
        return total / n if n else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        z = self.logits(text) if text and self.languages else None
        if z is None:
            return UNKNOWN, 0.0, False
        p = softmax(z / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def segments(text: Column) -> Column:
    """Up to ``SEGMENTS`` parts of ``SEGMENT`` characters, spread over the whole
    text, so a long text teaches no more than another."""
    n = F.ceil(F.length(text) / SEGMENT)
    taken = F.least(n, F.lit(SEGMENTS))
    return F.transform(F.sequence(F.lit(0).cast("bigint"), taken - 1), lambda i: F.substring(
        text, (F.floor(i * (n - 1) / F.greatest(taken - 1, F.lit(1))) * SEGMENT + 1).cast("int"), F.lit(SEGMENT)))


def fit(rows: list[tuple[list[str], str]], seed: int = 0) -> Model:
    """``rows``: (segments of a text, lang) in a fixed order.  Every fifth row is
    kept for calibration."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), 1.0, 1.0)
    rng, seen = np.random.default_rng(seed), dict.fromkeys(languages, 0)
    train, held = [], []
    for parts, lang in rows:
        seen[lang] += 1
        for g in map(grams, parts):
            if len(g):
                (held if seen[lang] % 5 == 0 else train).append((*np.unique(g, return_counts=True), languages.index(lang)))
    emb = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION)).astype(np.float32)
    out = np.zeros((DIMENSION, len(languages)), np.float32)
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(train)):
            ids, counts, y = train[k]
            share = (counts / counts.sum()).astype(np.float32)[:, None]
            hidden = (emb[ids] * share).sum(axis=0)
            g = softmax(hidden @ out)
            g[y] -= 1
            step = RATE * (1 - epoch / EPOCHS)
            back = out @ g
            out -= step * np.outer(hidden, g)
            emb[ids] -= step * share * back
    table = emb @ out
    if not held:
        return Model(languages, table, 1.0, 0.0)
    z = np.array([(table[i] * (c / c.sum())[:, None]).sum(axis=0) for i, c, _ in held])
    y = np.array([y for *_, y in held])
    loss = [(-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean(), t) for t in np.geomspace(0.1, 10, 41)]
    temperature = float(min(loss)[1])
    p = softmax(z / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-score)
    precise = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= PRECISION
    threshold = float(score[order][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0
    return Model(languages, table, temperature, threshold)


def training_rows(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[list[str], str]]:
    """Segments of about ``per_language`` rows of each language, chosen by a hash
    of the id, in hash order.  At most ``SEGMENTS`` times ``SEGMENT`` characters
    of a row reach the driver."""
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    key = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, n in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == lang) & (key < int(min(1.0, per_language / n) * (1 << 30))))
    picked = (labelled.where(chosen & (F.length("text") > 0)).select(key.alias("key"), "lang", segments(F.col("text")).alias("parts"))
              .orderBy("key", "lang", "parts").limit(2 * per_language * max(1, len(counts))))
    return [(r["parts"], r["lang"]) for r in picked.collect()]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _predict(shared):
    def predict(batches):
        model = Model(*shared.value)
        for batch in batches:
            out = [model.predict(t) for t in batch.column("text").to_pylist()]
            langs, scores, sure = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(sure, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"])
    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.table, model.temperature, model.threshold))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_predict(shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")


def train(docs: DataFrame) -> Model:
    """Learns from documents that are not held out and have a language."""
    labelled = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    return fit(training_rows(labelled))
