"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is the multiset of its hashed five-word shingles; the similarity of
two documents is the probability Jaccard of their shingle counts (equal to the
Jaccard similarity if no shingle repeats).  Documents are linked at ``LEVEL``
or more, and a class is a connected component of links.

1. Signature.  Each shingle has a Poisson process of arrivals at the rate of
   its count, seeded by its hash; each arrival goes to one of ``REGISTERS``
   registers, which keeps its earliest.  A shingle ends when its next arrival
   is later than every register.  Two documents agree on a register with the
   probability of their similarity.
2. Copies.  Documents with the same words are one node from here on, known by a
   digest of the words; its text is that of its row of the smallest id.
3. Banding.  Nodes that agree on all ``ROWS`` registers of one of ``BANDS``
   bands share a bucket (a similar pair misses all with a chance of 5e-5 at
   0.8, less above).
4. Verification.  Each bucket names a leader, whose similarity to every member
   is computed exactly from the shingles; links join components.  Buckets that
   still have two components or more are then compared in blocks: of each pair
   of blocks, all members of different components, again exactly.  So every
   pair of a bucket was compared or is joined already and no link between
   components is lost, while a group of copies mostly costs a comparison per
   member, and no pair leaves a task unless it is a link that joins components.

Buckets are aggregated before they are shuffled and joined back, or cut into
blocks, so a bucket or a class of any size never meets in one task.

Defined results: a text without a word (null, empty, blank) is in a class of
its own; rows without an id have no class; rows that share an id but not the
text are documents of their own, so they may be in different classes; rows that
share both are one document; an empty table gives an empty result; further
columns pass through ``deduplicated`` (of equal rows those of any one) and are
not read else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .batches import give_back, then_give_back
from .components import components
from .shingles import digest, mix, shingled

REGISTERS = 128
BANDS, ROWS = 25, 5
LEVEL = 0.8
BLOCK = 256
COLUMNS = 4096
_POINTS = 1024
SALTS = 16


def _arrivals(shingle: np.ndarray, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Waiting times (rate 1) and registers of arrivals first..first+n-1."""
    step = np.arange(first + 1, first + n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    x = mix(shingle[:, None] + step[None, :])
    return -np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53), (x % np.uint64(REGISTERS)).astype(np.int64)


def signature(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The shingle that each register keeps; ``shingle`` distinct, not empty."""
    earliest, kept = np.full(REGISTERS, np.inf), np.zeros(REGISTERS, np.uint64)
    clock, rate, done = np.zeros(len(shingle)), count.astype(np.float64), 0
    while len(shingle):
        n = max(1, _POINTS // len(shingle))
        wait, register = _arrivals(shingle, done, n)
        time = clock[:, None] + wait.cumsum(axis=1) / rate[:, None]
        np.minimum.at(earliest, register.ravel(), time.ravel())
        won = time == earliest[register]
        kept[register[won]] = np.broadcast_to(shingle[:, None], won.shape)[won]
        clock, done = time[:, -1], done + n
        going = clock < earliest.max()
        shingle, clock, rate = shingle[going], clock[going], rate[going]
    return kept


def bands(kept: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    rows = kept[:BANDS * ROWS].reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, r])
    return key


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two (sorted distinct shingles, counts)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    only_x, only_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    # For shingle i: 1 / sum_j max(x_j / x_i, y_j / y_i), by rank of x_j / y_j.
    ratio = x / y
    order = np.argsort(-ratio, kind="stable")
    x_above, y_above = np.cumsum(x[order]), np.cumsum(y[order])
    last = np.searchsorted(-ratio[order], -ratio, side="right") - 1
    return float((1 / ((only_x + x_above[last]) / x + (only_y + y.sum() - y_above[last]) / y)).sum())


@then_give_back
def _sign(batches):
    for batch in batches:
        out = []
        for words, shingle in shingled(batch.column("text")):
            if len(words):
                out.append((*digest(words), bands(signature(*np.unique(shingle, return_counts=True))).view(np.int64)))
            else:
                out.append((None, None, None))
        a, b, keys = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                          pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "content", "a", "b", "bands"])


@then_give_back
def _vectors(batches):
    """Shingles of the rows whose words are the node's (another row may have its id)."""
    for batch in batches:
        named = zip(batch.column("node").to_pylist(), batch.column("a").to_pylist(), batch.column("b").to_pylist())
        out = [(node, np.sort(s).tobytes()) for (node, a, b), (words, s) in zip(named, shingled(batch.column("text"))) if digest(words) == (a, b)]
        nodes, vectors = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(vectors, pa.binary())], names=["node", "vector"])


@then_give_back
def _compare(batches):
    def counted(raw):
        return np.unique(np.frombuffer(raw, np.uint64), return_counts=True)
    for batch in batches:
        sims = [similarity(counted(x), counted(y)) for x, y in
                zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("q"), pa.array(sims, pa.float64())],
                                         names=["p", "q", "similarity"])


def _order(node):
    return F.xxhash64(F.lit(1), node)


def _with_leader(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, node) -> (pairs p < q of a bucket's leader and its members,
    (bucket, node) of the buckets that have more pairs)."""
    leaders = (buckets.groupBy("bucket").agg(F.min(F.struct(_order(F.col("node")).alias("o"), "node")).alias("l"),
                                             F.count(F.lit(1)).alias("n"))
               .where("n > 1").select("bucket", F.col("l.node").alias("leader"), "n"))
    joined = materialize(buckets.join(leaders, "bucket").where("node <> leader"), "bucket-members")
    pairs = joined.select(F.least("node", "leader").alias("p"), F.greatest("node", "leader").alias("q")).distinct()
    leading = leaders.where("n > 2").select("bucket", F.col("leader").alias("node"))
    return pairs, joined.where("n > 2").select("bucket", "node").unionByName(leading)


def _links_within(level: float):
    def links(group):
        node, root = group.column("node").to_numpy(), group.column("root").to_numpy()
        side = group.column("side").to_numpy()
        vectors = [np.unique(np.frombuffer(v, np.uint64), return_counts=True) for v in group.column("vector").to_pylist()]
        out = linked_pairs(vectors, root, side, level)
        if len(vectors) > BLOCK:
            give_back()
        return pa.table({"a": node[[i for i, _ in out]], "b": node[[j for _, j in out]]},
                        schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    return links


def linked_pairs(vectors, root, side, level: float = LEVEL) -> list[tuple[int, int]]:
    """Pairs of similarity ``level`` or more that join different roots, enough
    to connect all that are connected.  Members of two sides are compared
    across; if there is one side only, all are.

    The share of a member's shingles that another one has bounds their
    similarity from above, and gives it exactly where no shingle repeats."""
    sizes = np.array([c.sum() for _, c in vectors], float)
    plain = np.array([len(s) for s, _ in vectors]) == sizes
    member = np.repeat(np.arange(len(vectors)), [len(s) for s, _ in vectors])
    shingle, at, times = np.unique(np.concatenate([s for s, _ in vectors]), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1  # columns for shingles of two members or more
    use = times[at] > 1
    member, column = member[use], shared[at[use]]
    weight = np.concatenate([c for _, c in vectors])[use]
    common = np.zeros((len(vectors), len(vectors)), np.float32)
    order = np.argsort(column, kind="stable")
    member, column, weight = member[order], column[order], weight[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        w = np.zeros((len(vectors), COLUMNS), np.float32)
        w[member[a:b], column[a:b] - start] = weight[a:b]
        common += w @ (w > 0).astype(np.float32).T
    bound = np.minimum(common / sizes[:, None], common.T / sizes)
    possible = np.triu(bound >= level - 1e-5, 1) & (root[:, None] != root[None, :])
    if len(set(side.tolist())) == 2:
        possible &= side[:, None] != side[None, :]
    parent, out = {r: r for r in root.tolist()}, []

    def find(r):
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r
    for i, j in zip(*np.nonzero(possible)):
        x, y = find(int(root[i])), find(int(root[j]))
        if x != y:
            s = (common[i, j] / (sizes[i] + sizes[j] - common[i, j]) if plain[i] and plain[j]
                 else similarity(vectors[i], vectors[j]))
            if s >= level:
                parent[max(x, y)] = min(x, y)
                out.append((int(i), int(j)))
    return out


def _rest(active: DataFrame, roots: DataFrame, vectors: DataFrame, level: float) -> DataFrame:
    """Links (a, b) between the components of each bucket of ``active``
    (bucket, node).  A bucket of m members is cut into about m / BLOCK blocks,
    and each pair of blocks is one group of bounded size."""
    rooted = materialize(active.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root")), "active")
    parts = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = (parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
             .select("bucket", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    block = F.pmod(F.xxhash64(F.lit(2), "node"), F.col("blocks"))
    dealt = (rooted.join(mixed, "bucket").join(vectors, "node").withColumn("own", block)
             .select("bucket", "node", "root", "vector", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("bucket", "node", "root", "vector", (F.col("own") > F.col("other")).cast("int").alias("side"),
                     F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    return dealt.groupBy("bucket", "i", "j").applyInArrow(_links_within(level), "a long, b long")


def _fetch(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(node, vector) of the nodes found (node, first_id, a, b); their side of
    the join is hashed."""
    texts = rows.join(found.hint("shuffle_hash"), F.col("doc_id") == F.col("first_id")).select("node", "a", "b", "text")
    return texts.mapInArrow(_vectors, "node long, vector binary").groupBy("node").agg(F.first("vector").alias("vector"))


def _content(text) -> F.Column:
    """Tells the rows of one id apart."""
    return F.xxhash64(F.lit(3), text)


def _classified(docs: DataFrame, level: float) -> DataFrame:
    """doc_id, content, copy_of and class (first_id of its smallest node, and a
    number that tells classes with the same first id apart) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = materialize(rows.withColumn("content", _content(F.col("text"))).select("doc_id", "content", "text")
                         .mapInArrow(_sign, "doc_id long, content long, a long, b long, bands array<long>"), "signatures")
    nodes = (signed.where("doc_id is not null and a is not null").groupBy("a", "b")
             .agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands")))
    # The number is the place in the stored table.
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    pairs, active = _with_leader(buckets)
    pairs, roots = materialize(pairs, "pairs"), None
    if not pairs.isEmpty():
        # Every bucket with two members or more is in the pairs.
        met = pairs.select(F.explode(F.array("p", "q")).alias("node")).distinct()
        vectors = materialize(_fetch(rows, nodes.join(met, "node").select("node", "first_id", "a", "b")), "vectors")
        both = (pairs.join(vectors.select(F.col("node").alias("p"), F.col("vector").alias("x")), "p")
                .join(vectors.select(F.col("node").alias("q"), F.col("vector").alias("y")), "q"))
        compared = both.mapInArrow(_compare, "p long, q long, similarity double")
        links = materialize(compared.where(F.col("similarity") >= level)
                            .select(F.col("p").alias("a"), F.col("q").alias("b")), "links")
        rest = materialize(_rest(active, components(links), vectors, level), "links")
        roots = components(links.unionByName(rest))
    named = nodes.select("a", "b", "node", "first_id")
    if roots is not None:
        rooted = materialize(named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted-nodes")
        # Classes of several nodes only, mostly few.
        firsts = (rooted.groupBy("root").agg(F.min("first_id").alias("class_id"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("root", "class_id"))
        named = rooted.join(firsts, "root", "left").withColumn("class_id", F.coalesce("class_id", "first_id"))
    else:
        named = named.withColumn("root", F.col("node")).withColumn("class_id", F.col("first_id"))
    named = named.select("a", "b", F.col("first_id").alias("copy_of"), "class_id", "root")
    return signed.select("doc_id", "content", "a", "b").join(named, ["a", "b"], "left").select(
        "doc_id", "content", F.when(F.col("doc_id").isNotNull(), F.coalesce("copy_of", "doc_id")).alias("copy_of"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("root"))


def classes(docs: DataFrame, level: float = LEVEL) -> DataFrame:
    """doc_id, class_id (smallest id of the class), class_size (its rows) and
    copy_of (smallest id with the same words)."""
    named = materialize(_classified(docs, level), "document-classes")
    # Classes of one row, mostly all, need no join; the others' rows are dealt by a salt.
    sizes = (named.where("root is not null").groupBy("root").agg(F.count(F.lit(1)).alias("class_size")).where("class_size > 1")
             .select(F.col("root").alias("r"), "class_size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = named.withColumn("s", F.pmod(F.xxhash64("doc_id", "content"), F.lit(SALTS)).cast("int"))
    return (salted.join(sizes, (F.col("root") == F.col("r")) & (F.col("s") == F.col("salt")), "left")
            .select("doc_id", "class_id", F.coalesce("class_size", F.when(F.col("doc_id").isNotNull(), 1)).alias("class_size"), "copy_of"))


def deduplicated(docs: DataFrame, level: float = LEVEL) -> DataFrame:
    """One document of each class, the one with the smallest id (of several, by
    a hash of the text); rows without an id all stay."""
    named = materialize(_classified(docs, level).where("doc_id is not null").select("doc_id", "content", "root"), "document-classes")
    chosen = F.struct("doc_id", "content")
    first = (named.where("root is not null").groupBy("root").agg(F.min(chosen).alias("kept"))
             .unionByName(named.where("root is null").select("root", chosen.alias("kept")))
             .select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.content").alias("kept_content")).distinct())
    rows = docs.select(F.struct("*").alias("doc")).select("doc", F.col("doc.doc_id").cast("bigint").alias("id"), _content(F.col("doc.text")).alias("content"))
    kept = (rows.where("id is not null").join(first.hint("shuffle_hash"), (F.col("id") == F.col("kept_id"))
                                              & F.col("content").eqNullSafe(F.col("kept_content")), "left_semi"))
    # Rows that repeat as they are: one of them, where there are any.
    if not named.groupBy("doc_id", "content").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        kept = kept.groupBy("id", "content").agg(F.first("doc").alias("doc"))
    return kept.select("doc").unionByName(rows.where("id is null").select("doc")).select("doc.*")
