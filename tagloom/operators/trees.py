"""One-vs-rest Gini decision trees for many targets at once.

An image is one row: its features (index and bin), its positive targets, and
nothing per target.  A forest is an array of splits per target and node (bounded
by targets times 2^depth, checked), which every task has; where an image stands
in each tree is found by walking down the splits, so nothing of size images x
targets is ever stored or shuffled.

Level-wise training in the style of MLlib, one job per level for all targets:

1. node counts          of a child are known from its parent's split; nodes with
   positives only or without any are leaves, their images cost nothing more
2. split counts         (target, node, f, bin) -> c, c1: a task walks its images,
   adds up in numpy, and emits only these counts
3. candidate splits     right side = bin >= j, counts by a cumulative window over
   the bins of one (target, node, f)
4. best split           max gain (rounded to 12 decimals), then smallest
   feature, then smallest threshold; gain must be > 0 and both children
   non-empty (MLlib's minInstancesPerNode = 1, minInfoGain = 0)

Bins are the candidate thresholds strictly below a value: fixed ones, or quantiles
of each feature (``quantile_bins``).  Leaves predict the majority class of their
training rows (ties -> 0).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..session import materialize, ship_package
from .features import is_train

BINARY_THRESHOLDS = [0.5]
SCORE_THRESHOLDS = [round(i / 20, 2) for i in range(1, 20)]
GAIN_DECIMALS = 12
MAX_CELLS = 5_000_000
QUANTILES = 32
SCORE_CELLS = 10_000
_ROWS = 512
_HELD = 2_000_000
# Cells (node, feature, bin) that a task counts in a table of its own; images it looks at together then.
_TABLE = 16_000_000
_TABLE_ROWS = 4096


# ---- bins ---------------------------------------------------------------------------------------------------------------

def bin_of(v, thresholds: list[float]) -> F.Column:
    """Number of thresholds strictly below v (0 = never on a right side)."""
    expr = F.lit(0)
    for t in thresholds:
        expr = expr + F.when(v > F.lit(t), 1).otherwise(0)
    return expr


def fixed_bins(features: DataFrame, thresholds: list[float]) -> DataFrame:
    """(id, f, v) -> (id, f, bin), without the rows of bin 0."""
    return features.select("id", "f", bin_of(F.col("v"), thresholds).alias("bin")).where("bin >= 1")


def score_cell(v) -> F.Column:
    """Place of a score in 0..1 among ``SCORE_CELLS`` equal cells (0: none)."""
    return F.ceil(v * SCORE_CELLS).cast("int")


def quantile_sketch(features: DataFrame) -> DataFrame:
    """(f, cell, n): a histogram of each feature's scores.  Sketches of parts of
    the data add up; a quantile read from it is right to 1 / ``SCORE_CELLS``."""
    return features.groupBy("f", score_cell(F.col("v")).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def merged_sketches(*sketches: DataFrame) -> DataFrame:
    out = sketches[0]
    for s in sketches[1:]:
        out = out.unionByName(s)
    return out.groupBy("f", "cell").agg(F.sum("n").alias("n"))


def quantile_thresholds(sketch: DataFrame, n_rows: int) -> DataFrame:
    """(f, cells): the cells at which the share of rows passes a multiple of 1 /
    ``QUANTILES``.  Rows without the feature (of ``n_rows``) have score 0."""
    missing = sketch.groupBy("f").agg(F.sum("n").alias("n")).select("f", F.lit(0).alias("cell"), (F.lit(n_rows) - F.col("n")).alias("n"))
    cells = merged_sketches(sketch, missing)
    upto = F.sum("n").over(Window.partitionBy("f").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))

    def step(n):
        return F.least(F.lit(QUANTILES - 1), F.floor(n * QUANTILES / n_rows))
    counted = cells.withColumn("upto", upto)
    return (counted.where(step(F.col("upto")) > step(F.col("upto") - F.col("n")))
            .groupBy("f").agg(F.array_sort(F.collect_list("cell")).alias("cells")))


def quantile_bins(features: DataFrame, train_ids: DataFrame) -> DataFrame:
    """(id, f, v) -> (id, f, bin) by quantiles of the training rows."""
    train = features.join(train_ids.select("id"), "id", "left_semi")
    table = quantile_thresholds(quantile_sketch(train), train_ids.count())
    own = F.size(F.filter("cells", lambda c: c < score_cell(F.col("v"))))
    return features.join(table, "f").select("id", "f", own.alias("bin")).where("bin >= 1")


# ---- images -------------------------------------------------------------------------------------------------------------

def target_list(labels: DataFrame) -> list[str]:
    """The modelled labels, sorted; their number is checked before they are read."""
    names = sorted(r[0] for r in labels.select("label").distinct().limit(10 * C.TOP_TAGS + 1).collect())
    if len(names) > 10 * C.TOP_TAGS:
        raise ValueError(f"too many target labels: more than {10 * C.TOP_TAGS}")
    return names


def image_rows(ids: DataFrame, binned: DataFrame, truth: DataFrame, targets: list[str],
               train_percent: int = C.TRAIN_PERCENT) -> DataFrame:
    """(id, train, fs, bins, positives): one stored row per image.  ``binned``
    (id, f, bin); ``truth`` (id, label)."""
    feats = (binned.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(F.col("f").cast("int").alias("f"), F.col("bin").cast("int").alias("bin")))).alias("x"))
             .select("id", F.col("x.f").alias("fs"), F.col("x.bin").alias("bins")))
    # At most as many rows as ``target_list`` lets through.
    places = ids.sparkSession.createDataFrame(list(zip(targets, range(len(targets)))), "label string, target int")
    wanted = truth.select("id", "label").join(F.broadcast(places), "label")
    positives = wanted.groupBy("id").agg(F.array_sort(F.collect_set("target")).alias("positives"))
    none = F.array().cast("array<int>")
    rows = (ids.select("id").distinct().join(feats, "id", "left").join(positives, "id", "left")
            .select("id", is_train(F.col("id"), train_percent).alias("train"), F.coalesce("fs", none).alias("fs"),
                    F.coalesce("bins", none).alias("bins"), F.coalesce("positives", none).alias("positives")))
    return materialize(rows, "forest-images")


# ---- the forest -----------------------------------------------------------------------------------------------------------

@dataclass
class Forest:
    """Splits by target and node (root 1, children 2n and 2n + 1): feature (-1:
    leaf), the bin from which a row goes right, and training counts."""

    targets: list[str]
    n_features: int
    feature: np.ndarray
    bin: np.ndarray
    n: np.ndarray
    n1: np.ndarray

    def nodes(self, dense: np.ndarray, depth: int) -> np.ndarray:
        """The node of every (image, target) after ``depth`` levels."""
        node = np.ones((len(dense), len(self.targets)), np.int64)
        column = np.arange(len(self.targets))[None, :]
        for _ in range(depth):
            f = self.feature[column, node]
            right = np.take_along_axis(dense, np.maximum(f, 0), axis=1) >= self.bin[column, node]
            node = np.where(f >= 0, 2 * node + right, node)
        return node

    def active(self, level: int) -> np.ndarray:
        """(target, node) of the nodes of a level that may be split, in order."""
        at = np.arange(1 << level, 2 << level)
        return np.argwhere((self.n1[:, at] > 0) & (self.n1[:, at] < self.n[:, at])) + [0, 1 << level]


def _matrix(batch: pa.RecordBatch, n_features: int):
    """(bins as a matrix, row of every feature, features, bins)."""
    sizes = np.diff(batch.column("fs").offsets.to_numpy())
    row = np.repeat(np.arange(len(batch)), sizes)
    f, b = batch.column("fs").flatten().to_numpy(), batch.column("bins").flatten().to_numpy()
    dense = np.zeros((len(batch), n_features), np.uint8)
    dense[row, f] = b
    return dense, row, f, b


def _small(batches, rows: int = _ROWS):
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)


def _table_counts(forest: Forest, level: int, width: int, n_bins: int, nodes: np.ndarray, number: np.ndarray, batches):
    """The counts of ``_split_counts`` in one table of all cells, target by target: the
    nodes of a target stand side by side, and no count is sorted."""
    n_columns = forest.n_features * n_bins
    upto = np.searchsorted(nodes[:, 0], np.arange(len(forest.targets) + 1))
    tables = [np.zeros(len(nodes) * n_columns, np.int32) for _ in range(2)]
    column = np.arange(len(forest.targets))[None, :]
    for batch in _small(batches, _TABLE_ROWS):
        dense, row, f, b = _matrix(batch, forest.n_features)
        place = number[column, forest.nodes(dense, level)]
        positive = _positives(batch, place.shape)
        cell = f.astype(np.int64) * n_bins + b - 1
        for t in range(len(forest.targets)):
            low, high = upto[t], upto[t + 1]
            if low == high:
                continue
            at, size = slice(low * n_columns, high * n_columns), (high - low) * n_columns
            for table, here in zip(tables, (place[:, t] >= 0, (place[:, t] >= 0) & positive[:, t])):
                base = ((place[:, t] - low) * n_columns)[row]
                use = here[row]
                table[at] += np.bincount((base + cell)[use], minlength=size).astype(np.int32)
    own = np.flatnonzero(tables[0])
    node, rest = np.divmod(own, n_columns)
    key = node * width + rest // n_bins * 256 + rest % n_bins + 1
    if len(own):
        yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(x[own].astype(np.int64)) for x in tables)], names=["key", "c", "c1"])


def _positives(batch: pa.RecordBatch, shape: tuple[int, int]) -> np.ndarray:
    positive = np.zeros(shape, bool)
    sizes = np.diff(batch.column("positives").offsets.to_numpy())
    positive[np.repeat(np.arange(len(batch)), sizes), batch.column("positives").flatten().to_numpy()] = True
    return positive


def _split_counts(shared, level: int, width: int, n_bins: int):
    """Training images -> (key, c, c1); the key is node * width + f * 256 + bin,
    with the nodes numbered as in ``Forest.active``."""
    def count(batches):
        forest = shared.value
        number = np.full(forest.feature.shape, -1, np.int64)
        nodes = forest.active(level)
        number[nodes[:, 0], nodes[:, 1]] = np.arange(len(nodes))
        if len(nodes) * forest.n_features * n_bins <= _TABLE:
            yield from _table_counts(forest, level, width, n_bins, nodes, number, batches)
            return
        column = np.arange(len(forest.targets))[None, :]
        keys, counts, held = [], [], 0

        def table():
            key, c = _added(keys, counts)
            own, at = np.unique(key >> 1, return_inverse=True)
            positive = np.bincount(at, weights=c * (key & 1), minlength=len(own)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(at, weights=c, minlength=len(own)).astype(np.int64)),
                                               pa.array(positive)], names=["key", "c", "c1"])
        for batch in _small(batches):
            dense, row, f, b = _matrix(batch, forest.n_features)
            place = number[column, forest.nodes(dense, level)]
            positive = _positives(batch, place.shape)
            entry, target = np.nonzero(place[row] >= 0)
            key = place[row[entry], target] * width + f[entry].astype(np.int64) * 256 + b[entry]
            key, c = np.unique(2 * key + positive[row[entry], target], return_counts=True)
            keys.append(key)
            counts.append(c)
            held += len(key)
            if held > _HELD:
                merged = _added(keys, counts)
                keys, counts, held = [merged[0]], [merged[1]], len(merged[0])
                if held > _HELD // 2:
                    yield table()
                    keys, counts, held = [], [], 0
        if keys:
            yield table()
    return count


def _gini(n, n1):
    p1 = n1.cast("double") / n.cast("double")
    return F.lit(1.0) - p1 * p1 - (F.lit(1.0) - p1) * (F.lit(1.0) - p1)


def _best_splits(counts: DataFrame, stats: DataFrame, width: int) -> DataFrame:
    """(node, f, j, nr, nr1): the best valid split of every node; ``counts``
    (key, c, c1) summed up, ``stats`` (node, n, n1)."""
    cells = counts.select(F.floor(F.col("key") / width).alias("node"), F.floor(F.col("key") % width / 256).alias("f"),
                          (F.col("key") % 256).alias("bin"), "c", "c1")
    w = Window.partitionBy("node", "f").orderBy(F.desc("bin"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cum = (cells.withColumn("nr", F.sum("c").over(upto)).withColumn("nr1", F.sum("c1").over(upto))
           .withColumn("j", F.coalesce(F.lead("bin").over(w), F.lit(0)) + 1))
    cand = (cum.join(F.broadcast(stats), "node")
            .withColumn("nl", F.col("n") - F.col("nr"))
            .withColumn("nl1", F.col("n1") - F.col("nr1"))
            .where((F.col("nr") >= 1) & (F.col("nl") >= 1))
            .withColumn("gain", F.round(
                _gini(F.col("n"), F.col("n1"))
                - F.col("nl") / F.col("n") * _gini(F.col("nl"), F.col("nl1"))
                - F.col("nr") / F.col("n") * _gini(F.col("nr"), F.col("nr1")), GAIN_DECIMALS))
            .where(F.col("gain") > 0))
    best = cand.groupBy("node").agg(F.min(F.struct((-F.col("gain")).alias("neg_gain"), "f", "j", "nr", "nr1")).alias("b"))
    return best.select("node", "b.f", "b.j", "b.nr", "b.nr1")


def train(images: DataFrame, targets: list[str], max_depth: int = C.TREE_DEPTH) -> Forest:
    """A forest for the rows of ``image_rows``."""
    spark = images.sparkSession
    ship_package(spark)
    rows = images.where("train")
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max("fs")).alias("f"),
                     F.max(F.array_max("bins")).alias("bins")).first()
    n_features = 1 + (found["f"] if found["f"] is not None else 0)
    cells = len(targets) << max_depth + 1
    if cells > MAX_CELLS:
        raise ValueError(f"a forest of {len(targets)} targets and depth {max_depth} exceeds its broadcast bound")
    shape = (len(targets), 2 << max_depth)
    forest = Forest(targets, n_features, np.full(shape, -1, np.int64), np.zeros(shape, np.int64),
                    np.zeros(shape, np.int64), np.zeros(shape, np.int64))
    if shape[0]:
        forest.n[:, 1] = found["n"]
    for r in rows.select(F.explode("positives").alias("t")).groupBy("t").count().collect():
        forest.n1[r["t"], 1] = r["count"]
    width = n_features * 256
    for level in range(max_depth):
        nodes = forest.active(level)
        if not len(nodes):
            break
        shared = spark.sparkContext.broadcast(forest)
        counts = (rows.mapInArrow(_split_counts(shared, level, width, found["bins"] or 1), "key long, c long, c1 long")
                  .groupBy("key").agg(F.sum("c").alias("c"), F.sum("c1").alias("c1")))
        stats = spark.createDataFrame([(i, int(forest.n[t, k]), int(forest.n1[t, k])) for i, (t, k) in enumerate(nodes)],
                                      "node long, n long, n1 long")
        # One row per node of the level at most, as bounded above.
        for s in _best_splits(counts, stats, width).collect():
            t, k = nodes[s["node"]]
            forest.feature[t, k], forest.bin[t, k] = s["f"], s["j"]
            forest.n[t, 2 * k + 1], forest.n1[t, 2 * k + 1] = s["nr"], s["nr1"]
            forest.n[t, 2 * k], forest.n1[t, 2 * k] = forest.n[t, k] - s["nr"], forest.n1[t, k] - s["nr1"]
        shared.unpersist()
    return forest


def predicted_pairs(forest: Forest, images: DataFrame, max_depth: int = C.TREE_DEPTH) -> DataFrame:
    """(id, label) for every positive prediction of the test images."""
    spark = images.sparkSession
    shared = spark.sparkContext.broadcast(forest)

    def predict(batches):
        own = shared.value
        positive = 2 * own.n1 > own.n
        names = pa.array(own.targets, pa.string())
        for batch in _small(batches):
            if len(own.targets):
                dense = _matrix(batch, own.n_features)[0]
                row, target = np.nonzero(positive[np.arange(len(names))[None, :], own.nodes(dense, max_depth)])
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), names.take(pa.array(target))], names=["id", "label"])
    kind = images.schema["id"].dataType.simpleString()
    test = images.where(~F.col("train"))
    # A feature that no training image has is in no split.
    keep = F.filter(F.arrays_zip("fs", "bins"), lambda x: x["fs"] < forest.n_features)
    return (test.withColumn("x", keep).select("id", F.col("x.fs").alias("fs"), F.col("x.bins").alias("bins"))
            .mapInArrow(predict, f"id {kind}, label string"))


def prediction_statistics(predicted: DataFrame, truth_test: DataFrame, how: str = "inner") -> DataFrame:
    """Per label: num_images (test images having it), num_predicciones,
    aciertos (test images having it that were also predicted).  Counts only,
    no id lists; labels lacking either side vanish with ``how='inner'``."""
    truth = truth_test.select("id", "label").distinct()
    pred = predicted.select("id", "label").distinct()
    n_images = truth.groupBy("label").agg(F.count(F.lit(1)).alias("num_images"))
    n_pred = pred.groupBy("label").agg(F.count(F.lit(1)).alias("num_predicciones"))
    hits = truth.join(pred, ["label", "id"], "left_semi").groupBy("label").agg(F.count(F.lit(1)).alias("aciertos"))
    out = n_pred.join(n_images, "label", how).join(hits, "label", "left")
    return out.select("label", F.coalesce("num_images", F.lit(0)).cast("bigint").alias("num_images"),
                      F.coalesce("num_predicciones", F.lit(0)).cast("bigint").alias("num_predicciones"),
                      F.coalesce("aciertos", F.lit(0)).cast("bigint").alias("aciertos"))
