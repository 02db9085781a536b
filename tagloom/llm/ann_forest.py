"""Approximate nearest neighbours (largest inner product) by a forest of
random-projection trees.

Fit.  ``TREES`` trees are fitted in numpy to ``SAMPLE`` rows (chosen by a hash
of the id; documented bound): each node splits its rows at the median of their
projections on the difference of two of them.  So that the nearest by distance
are those of the largest inner product, a row gets one more coordinate, which
brings it to the largest norm of all rows; a query gets 0 there.

Index.  Every row is filed under its leaf of every tree.

Search.  One priority queue per query holds nodes of all trees, nearest side
first; leaves are popped until ``SHARE`` of all leaves are, and on until one
tree's hold more than k rows of the sample.  Rows of these leaves, and no
others, are reranked exactly, in double precision on the given vectors.  The
queue works on the bounded forest alone, so queries are searched in parallel.

Rerank.  Leaves are grouped in chunks; rows and queries of a chunk are cut into
blocks by hash, and a pair of blocks is one group of bounded size.  The 20th
best inner product of a query with sample rows of the leaves it popped is a
lower bound of its 20th best in these leaves, so only rows above it leave the
group.  The sample gives this bound and no answers.

Identical vectors: of each vector only the k + 1 rows of the smallest ids are
filed; the others could never be among the k nearest, as ties go to the
smaller id.  All rows can be queries.

On vectors without structure more than two thirds of all rows have to be
visited for a recall above 0.9 at every size, which ``SHARE`` is set for; with
clustered vectors it can be lowered.

Defined results: rows whose id or vector is null, whose vector is zero, empty
or has a null or non-finite component, or is not of the most frequent length
(ties: the longer) take no part; rows of the same id and vector are one; rows
that share an id but not the vector are candidates of their own, but never of
the query's id, and as queries share one list, the best of both; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package

TREES = 4
SAMPLE = 16384
LEAF = 64
SHARE = 0.35
CHUNK_LEAVES = 32
BLOCK_ROWS = 4096
BLOCK_QUERIES = 4096


class Forest:
    """Complete binary trees; node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, rows: np.ndarray, trees: int, leaf: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.depth = max(0, int(np.log2(max(1, len(rows)) / leaf)))
        self.trees = [self._tree(rows, rng) for _ in range(trees)]

    def _tree(self, rows, rng):
        nodes = (1 << self.depth) - 1
        direction, at = np.zeros((nodes, rows.shape[1])), np.zeros(nodes)
        member = [np.arange(len(rows))]
        for node in range(nodes):
            own = member[node]
            pair = rows[rng.choice(own, 2, replace=False)] if len(own) > 1 else rng.normal(size=(2, rows.shape[1]))
            d = pair[0] - pair[1]
            direction[node] = d / max(np.linalg.norm(d), 1e-12)
            projected = rows[own] @ direction[node]
            at[node] = np.median(projected) if len(own) else 0.0
            member += [own[projected <= at[node]], own[projected > at[node]]]
        return direction, at

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree, trees by column."""
        out = np.zeros((len(rows), len(self.trees)), np.int64)
        for t, (direction, at) in enumerate(self.trees):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", rows, direction[node]) > at[node]
                node = 2 * node + 1 + right
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def search(self, query: np.ndarray, n_leaves: int, sizes: np.ndarray, least: int) -> list[tuple[int, int]]:
        """The first ``n_leaves`` (tree, leaf) that one queue over all trees
        pops, and more until one tree's hold ``least`` rows by ``sizes``."""
        margins = [direction @ query - at for direction, at in self.trees]
        first = (1 << self.depth) - 1
        queue, out, held = [(-np.inf, t, 0) for t in range(len(self.trees))], [], [0] * len(self.trees)
        while queue and (len(out) < n_leaves or max(held) < least):
            cost, t, node = heapq.heappop(queue)
            if node >= first:
                out.append((t, node - first))
                held[t] += sizes[t, node - first]
                continue
            m = margins[t][node]
            heapq.heappush(queue, (max(cost, m), t, 2 * node + 1))
            heapq.heappush(queue, (max(cost, -m), t, 2 * node + 2))
        return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in the order of the components."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest ** 2 - (rows ** 2).sum(axis=1), 0.0))
    return np.hstack([rows, rest[:, None]])


def _file(shared):
    def file(batches):
        forest, longest = shared.value["forest"], shared.value["longest"]
        for batch in batches:
            leaves = forest.leaves(lifted(_matrix(batch.column("v")), longest)) if len(batch) else np.zeros((0, 1), int)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(leaves.tolist(), pa.list_(pa.int32()))],
                                             names=["vec_id", "v", "leaves"])
    return file


def _probe(shared, share: float, k: int):
    def probe(batches):
        s = shared.value
        forest, ids, sample = s["forest"], s["ids"], s["sample"]
        all_leaves = 1 << forest.depth
        n = max(1, int(np.ceil(share * len(forest.trees) * all_leaves)))
        filed = forest.leaves(lifted(sample, s["longest"]))
        sizes = np.array([np.bincount(leaf, minlength=all_leaves) for leaf in filed.T])
        for batch in batches:
            rows, out = _matrix(batch.column("v")), []
            for q, v in zip(batch.column("vec_id").to_pylist(), rows):
                popped, chunks = np.zeros(sizes.shape, bool), {}
                for t, leaf in forest.search(np.append(v, 0.0), n, sizes, k + 1):
                    popped[t, leaf] = True
                    chunks.setdefault((t, leaf // CHUNK_LEAVES), []).append(leaf)
                seen = sample[popped[np.arange(len(sizes)), filed].any(axis=1) & (ids != q)]
                near = seen @ v
                bound = float(np.partition(near, -k)[-k]) if len(seen) >= k else -np.inf
                out.append((bound, [{"tree": t, "chunk": c, "leaves": x} for (t, c), x in chunks.items()]))
            bound, probes = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(bound, pa.float64()), pa.array(probes, pa.list_(_PROBE))],
                names=["query_id", "v", "bound", "probes"])
    return probe


_PROBE = pa.struct([("tree", pa.int32()), ("chunk", pa.int32()), ("leaves", pa.list_(pa.int32()))])
_NONE = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})


def _rerank(k: int):
    def rerank(queries, rows):
        if not len(queries) or not len(rows):
            return _NONE
        q, r = _matrix(queries.column("v")), _matrix(rows.column("v"))
        leaf, visited = rows.column("leaf").to_numpy(), np.zeros((len(q), CHUNK_LEAVES), bool)
        for i, leaves in enumerate(queries.column("leaves").to_pylist()):
            visited[i, np.array(leaves) % CHUNK_LEAVES] = True
        qid, rid, bound = (t.column(c).to_numpy() for t, c in ((queries, "query_id"), (rows, "vec_id"), (queries, "bound")))
        good = (q @ r.T >= bound[:, None] - 1e-9 * (1 + np.abs(bound[:, None]))) & visited[:, leaf % CHUNK_LEAVES]
        i, j = np.nonzero(good & (qid[:, None] != rid[None, :]))
        score = inner(q[i], r[j])
        # The k best of each query: no other row of this group can be among its k best of all.
        order = np.lexsort((rid[j], -score, i))
        place = np.arange(len(i)) - np.searchsorted(i[order], i[order], "left")
        best = order[place < k]
        return pa.table({"query_id": qid[i[best]], "vec_id": rid[j[best]], "score": score[best]})
    return rerank


def usable(table: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, v, norm) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id).cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: F.coalesce(x.between(-1.7976931348623157e308, 1.7976931348623157e308), F.lit(False)))
        & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("n", F.size("v"))
    length = rows.groupBy("n").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return rows.where(F.col("n") == (length["n"] if length else 0)).select("vec_id", "v", norm.alias("norm"))


def nearest(table: DataFrame, queries, id: str = "vec_id", vector: str = "embedding", k: int = 20, trees: int = TREES,
            share: float = SHARE, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query.
    ``queries``: a condition on the column ``vec_id``."""
    spark = table.sparkSession
    ship_package(spark)
    rows = materialize(usable(table, id, vector).distinct(), "vectors")
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    filed = materialize(rows.withColumn("copy", first).where(F.col("copy") <= k + 1).select("vec_id", "v", "copy"), "distinct-vectors")
    n, n_queries = filed.count(), rows.where(queries).count()
    key = F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(1 << 30))
    picked = filed.where(key < int(min(1.0, sample / max(n, 1)) * (1 << 30))).orderBy("vec_id", "v").limit(2 * sample).collect()
    longest = rows.agg(F.max("norm")).first()[0] or 0.0
    ids, points = np.array([r["vec_id"] for r in picked], np.int64), np.array([r["v"] for r in picked], float)
    points = points.reshape(len(ids), len(picked[0]["v"]) if picked else 1)
    distinct = np.array([r["copy"] == 1 for r in picked], bool)
    forest = Forest(lifted(points[distinct], longest), trees, leaf)
    shared = spark.sparkContext.broadcast({"forest": forest, "ids": ids, "sample": points, "longest": longest})
    probed = rows.where(queries).select("vec_id", "v").repartition(
        max(1, min(2 * spark.sparkContext.defaultParallelism, -(-n_queries // 64))), "vec_id").mapInArrow(
        _probe(shared, share, k), "query_id long, v array<double>, bound double, probes array<struct<tree:int,chunk:int,leaves:array<int>>>")
    probed = materialize(probed, "probes")
    chunks = max(1, (1 << forest.depth) // CHUNK_LEAVES)
    row_blocks, query_blocks = (max(1, -(-m // b)) for m, b in ((n // chunks, BLOCK_ROWS), (n_queries, BLOCK_QUERIES)))
    index = (filed.mapInArrow(_file(shared), "vec_id long, v array<double>, leaves array<int>")
             .select("vec_id", "v", F.posexplode("leaves").alias("tree", "leaf"))
             .withColumn("chunk", F.floor(F.col("leaf") / CHUNK_LEAVES).cast("int"))
             .withColumn("rb", F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>"))))
    asked = (probed.select("query_id", "v", "bound", F.explode("probes").alias("p")).select("query_id", "v", "bound", "p.*")
             .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)))
             .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)).cast("array<bigint>"))))
    group = ["tree", "chunk", "rb", "qb"]
    found = asked.groupBy(*group).cogroup(index.groupBy(*group)).applyInArrow(_rerank(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.distinct().withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
