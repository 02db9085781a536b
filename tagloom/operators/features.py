"""Training tables for cross-vocabulary label inference.

All tables are long form so that every step is a join or a grouped count:

* pairs    (id, label)            truth of one vocabulary
* features (id, f, v)             sparse feature values, f = vocabulary index
* targets  (target, id, y, train) one row per (modelled label, image)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C

# Hash split: bucket in [0, 100) from the id alone (deterministic, SQL-portable).
SPLIT_MODULUS = 1000003
SPLIT_MULTIPLIER = 7919
SPLIT_OFFSET = 13


def split_bucket(id_col) -> F.Column:
    return F.pmod(F.pmod(id_col, SPLIT_MODULUS) * SPLIT_MULTIPLIER + SPLIT_OFFSET, 100)


def is_train(id_col, train_percent: int = C.TRAIN_PERCENT) -> F.Column:
    return split_bucket(id_col) < train_percent


def common_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Images present in both vocabularies (inner join on id)."""
    return a.select("id").distinct().join(b.select("id").distinct(), "id")


def term_vocabulary(pairs: DataFrame, size: int = C.VOCAB_SIZE) -> DataFrame:
    """(label, f): the ``size`` most frequent labels (ties by label), indexed
    from 0.  Top-k first (partial top-k per task), so the numbering window
    only sees ``size`` rows."""
    counts = pairs.groupBy("label").agg(F.count(F.lit(1)).alias("tf"))
    top = counts.orderBy(F.desc("tf"), F.asc("label")).limit(size)
    return top.select("label", (F.row_number().over(Window.orderBy(F.desc("tf"), F.asc("label"))) - 1)
                      .cast("bigint").alias("f"))


def bag_of_words(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(id, f, v) term counts per image over the vocabulary."""
    return (pairs.join(F.broadcast(vocabulary), "label")
            .groupBy("id", "f").agg(F.count(F.lit(1)).cast("double").alias("v")))


def targets_table(ids: DataFrame, truth: DataFrame, labels: DataFrame,
                  train_percent: int = C.TRAIN_PERCENT) -> DataFrame:
    """(target, id, y, train): every image once per modelled label.

    The label set is one row holding an array (bounded by the number of
    modelled labels, checked), exploded per image: no join of two big sides."""
    n = labels.count()
    if n > 10 * C.TOP_TAGS:
        raise ValueError(f"too many target labels: {n}")
    label_row = labels.agg(F.collect_list("label").alias("_targets")).withColumn("_k", F.lit(0))
    expanded = (ids.withColumn("_k", F.lit(0)).join(F.broadcast(label_row), "_k")
                .select("id", F.explode("_targets").alias("target")))
    positives = truth.select("id", F.col("label").alias("target")).distinct().withColumn("_y", F.lit(1))
    return (expanded.join(positives, ["id", "target"], "left")
            .select("target", "id", F.coalesce("_y", F.lit(0)).cast("int").alias("y"),
                    is_train(F.col("id"), train_percent).alias("train")))
