"""Batch scoring of feature vectors with a pre-trained classifier, top-k labels.

The "pre-trained model" is a nearest-centroid softmax classifier whose
centroids Spark aggregates from labelled vectors (``embeddings``).  Scoring
stays JVM-side: the model is one row (classes x dim doubles, size checked
before it is broadcast), every vector is scored with array expressions
(``zip_with`` + ``aggregate``), and the top-k is a sort of a k-sized array per
row, so no shuffle and no window is needed.

Logits are negative squared distances of the standardised vector
``(v - mean) / scale`` to each standardised centroid, probabilities their
softmax.  Equal probabilities rank by node id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.text import _let
from ..session import materialize

# Broadcast guard: largest model (classes x dimensions) shipped to executors.
MAX_MODEL_CELLS = 4_000_000


def standardize(vec, mean: float = C.PIXEL_MEAN, scale: float = C.PIXEL_SCALE):
    return F.transform(vec, lambda v: (v.cast("double") - F.lit(mean)) / F.lit(scale))


def centroid_model(vectors: DataFrame, vec: str = "embedding", label: str = "label") -> DataFrame:
    """(node INT, centroid ARRAY<DOUBLE>) mean of the standardised vectors per
    class.  posexplode + grouped average: partial aggregation keeps the
    shuffle at classes x dim rows per task."""
    cells = vectors.where(F.col(vec).isNotNull()).select(
        F.col(label).alias("node"), F.posexplode(standardize(F.col(vec))).alias("pos", "v"))
    means = cells.groupBy("node", "pos").agg(F.avg("v").alias("m"))
    return (means.groupBy("node")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("cells"))
            .select("node", F.transform("cells", lambda c: c["m"]).alias("centroid")))


def model_row(model: DataFrame) -> DataFrame:
    """The whole model as one row ``(_k, classes, dim)``.  The per-class table
    is computed once (checkpoint) and its size -- classes x dim -- is checked
    with a plain aggregate before anything is gathered into one row or
    broadcast."""
    model = materialize(model, "model")
    stats = model.agg(F.count(F.lit(1)).alias("n_classes"), F.max(F.size("centroid")).alias("dim")).first()
    cells = int(stats["n_classes"] or 0) * int(stats["dim"] or 0)
    if cells > MAX_MODEL_CELLS:
        raise ValueError(f"model too large to broadcast: {cells} cells")
    row = model.agg(F.array_sort(F.collect_list(F.struct("node", "centroid"))).alias("classes"),
                    F.max(F.size("centroid")).alias("dim"))
    # Stored once: every batch of the stream and every branch broadcasts it.
    return materialize(row, "model-row").withColumn("_k", F.lit(0))


def probabilities(vec, classes):
    """array<struct<node, prob>> softmax over the classes (vec standardised).

    Each intermediate (standardised vector, logits, max, exponentials, sum) is
    bound once with ``_let``: interpreted lambdas do not share common
    sub-expressions, so an unbound reference would be re-evaluated per class."""
    def with_x(x):
        logits = F.transform(classes, lambda c: F.struct(
            c["node"].alias("node"),
            (-F.aggregate(F.zip_with(x, c["centroid"], lambda a, b: (a - b) * (a - b)),
                          F.lit(0.0), lambda s, v: s + v)).alias("logit")))

        def with_logits(lg):
            def with_top(top):
                exps = F.transform(lg, lambda l: F.struct(l["node"].alias("node"),
                                                          F.exp(l["logit"] - top).alias("e")))

                def with_exps(ex):
                    total = F.aggregate(ex, F.lit(0.0), lambda s, e: s + e["e"])
                    return _let(total, lambda t: F.transform(
                        ex, lambda e: F.struct(e["node"].alias("node"), (e["e"] / t).alias("prob"))))
                return _let(exps, with_exps)
            return _let(F.array_max(F.transform(lg, lambda l: l["logit"])), with_top)
        return _let(logits, with_logits)
    return _let(standardize(vec), with_x)


def top_k(probs, k: int):
    """k best (node, prob) by prob desc, node asc, with their 1-based rank."""
    ordered = F.sort_array(F.transform(probs, lambda p: F.struct(
        (-p["prob"]).alias("neg"), p["node"].alias("node"), p["prob"].alias("prob"))))
    return F.slice(ordered, 1, k)


def valid_vector(vec, dim) -> F.Column:
    return (vec.isNotNull() & (F.size(vec) == dim)
            & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v)))


def score_vectors(images: DataFrame, model: DataFrame, key: str, vec: str = "embedding",
                  k: int = C.MAX_SCORE_LABELS) -> DataFrame:
    """(key, rank, node, prob) for valid vectors; invalid ones get no rows
    (see ``with_sentinel``)."""
    m = F.broadcast(model_row(model))
    scored = (images.withColumn("_k", F.lit(0)).join(m, "_k")
              .where(valid_vector(F.col(vec), F.col("dim")))
              .select(key, F.posexplode(top_k(probabilities(F.col(vec), F.col("classes")), k)).alias("pos", "t")))
    return scored.select(key, (F.col("pos") + 1).alias("rank"), F.col("t.node").alias("node"),
                         F.col("t.prob").alias("prob"))


def name_nodes(scored: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Node id -> label name; unknown ids get ''.  Spark picks the join by the
    dictionary's size in bytes."""
    d = dictionary.select(F.col("node_id").alias("node"), F.col("name"))
    return scored.join(d, "node", "left").withColumn("label", F.coalesce("name", F.lit(""))).drop("name")


def running_total(df: DataFrame, order: list[str], amount: str, out: str) -> DataFrame:
    """``df`` with the sum of ``amount`` over the rows before each, in the order of
    ``order``.

    The rows are sorted by range and stored; each task's rows are summed up on
    their own and moved up by the sums of the tasks before it, of which there is
    one number each."""
    parted = materialize(df.orderBy(*order).withColumn("_part", F.spark_partition_id()), "sorted")
    sums = parted.groupBy("_part").agg(F.sum(amount).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.coalesce(F.sum(amount).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (parted.withColumn("_own", own).join(sums.select("_part", before.alias("_first")), "_part")
            .withColumn(out, (F.col("_own") + F.col("_first")).cast("bigint")).drop("_part", "_own", "_first"))


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with each row's position, from 0, in the order of ``order``."""
    return running_total(df.withColumn("_one", F.lit(1)), order, "_one", out).drop("_one")


def nation_dictionary(nation: DataFrame) -> DataFrame:
    """Stand-in node dictionary: nation key -> nation name."""
    return nation.select(F.col("n_nationkey").alias("node_id"), F.col("n_name").alias("name"))


def classify_images(index: DataFrame, contents: DataFrame, model: DataFrame, dictionary: DataFrame,
                    key: str, k: int = C.MAX_SCORE_LABELS) -> DataFrame:
    """Scores of every listed image: (key, label, score).

    Images without content, or with an invalid vector, produce the single
    sentinel row (``__None__``, 1.0) -- any failure, not only one kind."""
    joined = index.join(contents, key, "left")
    m = model_row(model)
    with_dim = joined.withColumn("_k", F.lit(0)).join(F.broadcast(m), "_k")
    ok = valid_vector(F.col("embedding"), F.col("dim"))
    best = F.transform(top_k(probabilities(F.col("embedding"), F.col("classes")), k), lambda t: F.struct(
        t["node"].alias("node"), t["prob"].alias("score"), F.lit(True).alias("scored")))
    none = F.array(F.struct(F.lit(None).cast("int").alias("node"), F.lit(C.NONE_SCORE).alias("score"), F.lit(False).alias("scored")))
    rows = with_dim.select(key, F.explode(F.when(ok, best).otherwise(none)).alias("t")).select(key, "t.*")
    return name_nodes(rows, dictionary).select(
        key, F.when(F.col("scored"), F.col("label")).otherwise(C.NONE_LABEL).alias("label"), "score")
