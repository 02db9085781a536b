"""Packing documents into training sequences by lexical retrieval.

The documents are encoded once and stored.  Document frequencies and the mean
length are those of all documents.  A document's BM25 weights are projected to
``DIM`` numbers, and a tree fitted to a sample (``Router``) files it in a cell
of similar documents.  The cells in the order of the tree, with their sizes as in
the sample, are cut into shards of about ``SHARD`` documents; a cell that spans
several shards is dealt to them by a hash, so no shard grows with a group of
copies.

Each shard is one group of one task: it builds a BM25 inverted index over its
documents' tokens, and packs.  The document that opens a window is its seed;
the index returns the seed's unused neighbours, best first, and they fill the
window.  The document that does not fit is cut there, and its rest opens the
next window and is the next seed.  So each window but a shard's last is full.
The last is cut into sequences of powers of two, which need no padding.

Ids cross one shuffle (to their shard).  The number of shards grows with the
documents, so a shard stays as large as it is; every seed's query uses all of
its tokens against all documents of the shard.  It does not reach the
neighbours that the tree filed in other shards: copies and close variants meet,
of loosely related documents a part (README has the measured shares).  The
sample has ``PER_SHARD`` rows a shard and ``MAX_SAMPLE`` at most; beyond about
4 million documents a shard's cells are therefore coarser.

Defined results: a null or empty text is its end token alone; repeated rows are
packed each; ties of the score go to the document that comes first by id, then
tokens; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .batches import give_back, pieces_of, then_give_back
from .tokenizing import read_definition, token_ids

WINDOW = 4096
END = 2
SHARD = 1000
K1, B = 1.2, 0.75
DIM = 64
PER_SHARD = 32
MAX_SAMPLE = 1 << 17
CELL = 8
ROWS = 256
BYTES = 1 << 21
SALTS = 1 << 30


class Corpus(NamedTuple):
    """What BM25 needs to know of all documents."""

    mean: float
    idf: np.ndarray  # by term


def inverse_frequency(n: int, df: np.ndarray) -> np.ndarray:
    return np.log1p((n - df + 0.5) / (df + 0.5))


@functools.lru_cache(maxsize=2)
def _directions(n_terms: int) -> np.ndarray:
    return np.random.default_rng(4).standard_normal((n_terms, DIM), np.float32)


def projected(docs: list[np.ndarray], corpus: Corpus) -> np.ndarray:
    """Random projections of the documents' BM25 weights, of length 1."""
    out, directions = np.zeros((len(docs), DIM), np.float32), _directions(len(corpus.idf))
    for i, d in enumerate(docs):
        term, tf = np.unique(d, return_counts=True)
        weight = corpus.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(d) / corpus.mean))
        out[i] = weight.astype(np.float32) @ directions[term]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), np.float32(1e-12))


class Router:
    """Complete binary tree over projected documents: a node splits its rows at
    the median of the direction in which they differ most.  Neighbouring cells
    have neighbouring numbers."""

    def __init__(self, rows: np.ndarray):
        self.depth = max(0, int(np.log2(max(1, len(rows)) / CELL)))
        nodes = (1 << self.depth) - 1
        self.direction, self.at = np.zeros((nodes, DIM)), np.zeros(nodes)
        member = [rows.astype(float)]
        for node in range(nodes):
            own = member[node]
            if len(own) > 1:
                self.direction[node] = np.linalg.eigh(np.cov(own, rowvar=False))[1][:, -1]
                along = own @ self.direction[node]
                self.at[node] = np.median(along)
            right = own @ self.direction[node] > self.at[node]
            member += [own[~right], own[right]]
            member[node] = None

    def cells(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (np.einsum("ij,ij->i", rows.astype(float), self.direction[node]) > self.at[node])
        return node - ((1 << self.depth) - 1)


class Index:
    """BM25 inverted index of one shard: postings sorted by term.  Without
    ``corpus`` the shard is all there is."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        self.terms = [np.unique(d, return_counts=True) for d in docs]
        n, lengths = len(docs), np.array([len(d) for d in docs], float)
        term = np.concatenate([t for t, _ in self.terms])
        tf = np.concatenate([c for _, c in self.terms]).astype(float)
        doc = np.repeat(np.arange(n), [len(t) for t, _ in self.terms])
        order = np.argsort(term, kind="stable")
        term, tf, self.doc = term[order], tf[order], doc[order]
        self.vocabulary, self.start, df = np.unique(term, return_index=True, return_counts=True)
        self.end = self.start + df
        idf = corpus.idf[self.vocabulary] if corpus else inverse_frequency(n, df)
        norm = K1 * (1 - B + B * lengths / (corpus.mean if corpus else lengths.mean()))
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.doc])
        self.n = n

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the tokens of the seed."""
        at = np.searchsorted(self.vocabulary, self.terms[seed][0])
        start, size = self.start[at], self.end[at] - self.start[at]
        where = np.repeat(start - np.concatenate([[0], size.cumsum()[:-1]]), size) + np.arange(size.sum())
        return np.bincount(self.doc[where], weights=self.weight[where], minlength=self.n)


def order(docs: list[np.ndarray], window: int = WINDOW, corpus: Corpus | None = None) -> list[int]:
    """The documents in packing order: each window's seed, then its nearest
    unused neighbours until the window is full."""
    index, unused = Index(docs, corpus), np.ones(len(docs), bool)
    seed, placed, out, next_free = 0, len(docs[0]), [0], 1
    unused[0] = False
    while len(out) < len(docs):
        scores = np.where(unused, index.scores(seed), -1.0)
        room = -placed % window
        while True:
            pick = int(scores.argmax())
            if scores[pick] <= 0:  # no neighbour is left: the next document in order
                while not unused[next_free]:
                    next_free += 1
                pick = next_free
            unused[pick], scores[pick] = False, -1.0
            out.append(pick)
            placed += len(docs[pick])
            if len(docs[pick]) >= room or len(out) == len(docs):
                seed = pick
                break
            room -= len(docs[pick])
    return out


def sequence_lengths(total: int, window: int = WINDOW) -> list[int]:
    """Full windows, then the powers of two that make up the rest."""
    rest = total % window
    return [window] * (total // window) + [1 << b for b in range(window.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: list[np.ndarray], window: int = WINDOW, corpus: Corpus | None = None):
    """(document, start, length, sequence, offset) of every piece."""
    lengths = iter(sequence_lengths(sum(map(len, docs)), window))
    sequence, offset, size = 0, 0, next(lengths)
    for d in order(docs, window, corpus):
        start = 0
        while start < len(docs[d]):
            take = min(len(docs[d]) - start, size - offset)
            yield d, start, take, sequence, offset
            start, offset = start + take, offset + take
            if offset == size:
                sequence, offset, size = sequence + 1, 0, next(lengths, 0)


def _parts(batches):
    """The batches in parts of ``ROWS`` rows, which bounds what a worker holds decoded."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def _ids(column, type: str) -> list[np.ndarray]:
    return [np.frombuffer(b, type).astype("<u4") for b in column.to_pylist()]


def _encode(definition, type: str):
    def encode(batches):
        library = token_ids(definition.value)
        for whole in batches:
            for batch in pieces_of(whole, "text", BYTES):
                ids, starts = library.of_batch(batch.column("text"), END)
                raw = ids.astype(type)
                column = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(starts * raw.itemsize), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column.cast(pa.binary())], names=["doc_id", "ids"])
    return then_give_back(encode)


def _frequencies(type: str, n_terms: int):
    def count(batches):
        df, docs, tokens = np.zeros(n_terms, np.int64), 0, 0
        for batch in _parts(batches):
            for d in _ids(batch.column("ids"), type):
                df[np.unique(d)] += 1
                docs, tokens = docs + 1, tokens + len(d)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(term, [-1, -2])), pa.array(np.append(df[term], [docs, tokens]))], names=["term", "n"])
    return then_give_back(count)


def _project(corpus, type: str):
    def project(batches):
        for batch in _parts(batches):
            rows = projected(_ids(batch.column("ids"), type), corpus.value)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary())], names=["row"])
    return then_give_back(project)


def _route(corpus, router, sizes: np.ndarray, shards: int, type: str):
    """The cells lie one behind the other, each as long as its part of the sample,
    the rows of a cell by their salt; every shard gets an equal part of the whole."""
    ends = np.cumsum(sizes)

    def route(batches):
        for batch in _parts(batches):
            cell = router.value.cells(projected(_ids(batch.column("ids"), type), corpus.value))
            at = ends[cell] - sizes[cell] + sizes[cell] * (batch.column("salt").to_numpy() / SALTS)
            shard = np.minimum((at * shards / ends[-1]).astype(np.int64), shards - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(shard)], names=["doc_id", "ids", "shard"])
    return then_give_back(route)


def _pack_shard(corpus, with_ids: bool, window: int, type: str):
    def pack(key, group):
        group = group.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        docs = _ids(group.column("ids"), type)
        rows = np.array(list(pieces(docs, window, corpus.value)), np.int64)
        doc, start, length, sequence, offset = rows.T
        cut = [docs[d][s:s + n] for d, s, n in zip(doc, start, length)]
        out = {"doc_id": group.column("doc_id").take(pa.array(doc)), "start": start, "length": length,
               "ids_crc32": np.array([zlib.crc32(c.tobytes()) for c in cut], np.int64),
               "doc_tokens": np.array([len(d) for d in docs], np.int64)[doc],
               "sequence_id": (key[0].as_py() << 32) + sequence, "offset": offset}
        if with_ids:
            out["input_ids"] = pa.ListArray.from_arrays(np.concatenate([[0], length.cumsum()]).astype(np.int32),
                                                        np.concatenate(cut).astype(np.int32))
        out = pa.table(out)
        give_back()
        return out
    return pack


def routed(encoded: DataFrame, shard: int, type: str, n_terms: int) -> tuple[DataFrame, Corpus]:
    """doc_id, ids and shard of every document of ``encoded`` (doc_id, ids), and
    the statistics of all of them.  The number of terms is the vocabulary's."""
    spark = encoded.sparkSession
    counted = encoded.select("ids").mapInArrow(_frequencies(type, n_terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    n, tokens, df = found.pop(-1, 0), found.pop(-2, 0), np.zeros(n_terms)
    df[list(found)] = list(found.values())
    corpus = Corpus(tokens / max(n, 1), inverse_frequency(n, df))
    shards = max(1, -(-n // shard))
    if shards == 1:
        return encoded.withColumn("shard", F.lit(0).cast("bigint")), corpus
    shared = spark.sparkContext.broadcast(corpus)
    size = min(MAX_SAMPLE, PER_SHARD * shards)
    # With the row's place in the stored table, so that of rows that repeat a fair part is drawn, and they are dealt apart.
    key, salt = (F.pmod(F.xxhash64(F.lit(k), "doc_id", "ids", F.monotonically_increasing_id()), F.lit(SALTS)) for k in (4, 5))
    rows = (encoded.withColumn("key", key).where(F.col("key") < int(min(1.0, size / n) * SALTS)).select("ids")
            .mapInArrow(_project(shared, type), "row binary").orderBy("row").limit(2 * size).collect())
    sample = np.frombuffer(b"".join(sorted(bytes(r["row"]) for r in rows)), np.float32).reshape(-1, DIM)
    router = Router(sample)
    tree = spark.sparkContext.broadcast(router)
    # A cell's part of all documents is that of the sample, in which a shard has PER_SHARD rows.
    sizes = np.bincount(router.cells(sample), minlength=1 << router.depth) + 1
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return (encoded.select("doc_id", "ids", salt.alias("salt"))
            .mapInArrow(_route(shared, tree, sizes, shards, type), f"doc_id {kind}, ids binary, shard long"), corpus)


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, shard: int = SHARD, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of
    every piece, and its input_ids if asked for.  ``tokenizer``: path of the file."""
    spark = docs.sparkSession
    ship_package(spark)
    definition = read_definition(tokenizer)
    n_terms = max(END, *token_ids(definition).library.get_vocab().values()) + 1
    type = "<u2" if n_terms <= 1 << 16 else "<u4"
    kind = docs.schema["doc_id"].dataType.simpleString()
    path = scratch_path(spark, "packing-ids")
    (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
     .mapInArrow(_encode(spark.sparkContext.broadcast(definition), type), f"doc_id {kind}, ids binary")
     .write.option("compression", "zstd").parquet(path))
    dealt, corpus = routed(spark.read.parquet(path), shard, type, n_terms)
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, "
              "doc_tokens long, sequence_id long, offset long" + (", input_ids array<int>" if with_ids else ""))
    return dealt.groupBy("shard").applyInArrow(_pack_shard(spark.sparkContext.broadcast(corpus), with_ids, window, type), schema)
