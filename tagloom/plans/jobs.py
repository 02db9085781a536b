"""End-to-end batch jobs: the reference's three batch programs as Spark jobs.

Each job reads its inputs, builds one Catalyst plan per output from the
operators in ``tagloom.operators`` and writes every dataset the reference
writes (same content, same file layout: text / JSON / ``~`` CSV / ``,`` CSV,
file counts through ``coalesce`` where asked for).  Intermediate results read by several
sinks are persisted for the duration of the job and released at the end.
Timestamps of start / processing / end are logged like the reference does.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import features as FE
from ..operators import langid as L
from ..operators import scoring as SC
from ..operators import tags as T
from ..operators import trees as TR
from ..sources import sinks

log = logging.getLogger("tagloom.jobs")


def _stamp(what: str) -> None:
    log.info("%s: %s", what, datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))


def _dir(base: str) -> str:
    return base if base.endswith("/") else base + "/"


def tag_analysis_job(spark: SparkSession, raw_lines: DataFrame, scores: DataFrame, out_dir: str,
                     language_lines: DataFrame | None = None, files: int | None = None) -> dict[str, str]:
    """raw_lines (image, label) tag lines; scores (image, label, score) of the
    image model.  Writes the ten outputs and returns their paths.  ``files``
    sets the number of files of each large output; by default each task writes
    its own."""
    out = _dir(out_dir)
    paths = {}
    _stamp("start")
    raw = raw_lines.persist(StorageLevel.MEMORY_AND_DISK)
    if language_lines is not None:
        model, langs = L.train(language_lines)
        # A prediction depends on the line's text alone: one per distinct line.
        counted = raw.where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        keyed = counted.select(F.col("label").alias("_line"), "n", "label")
        pred = L.predict(keyed, model, langs, ["_line", "n"])
        hist = pred.groupBy(F.col("lang").alias("idioma")).agg(F.sum("n").alias("count"))
        paths["languages"] = out + "user_tags/idiomas"
        sinks.write_delimited(hist, paths["languages"], ",", files=3)
    tags = T.normalized_tags(raw).persist(StorageLevel.MEMORY_AND_DISK)
    counts = T.tag_counts(tags).persist(StorageLevel.MEMORY_AND_DISK)
    paths["common_tags"] = out + "user_tags/comunes"
    sinks.write_text(T.top_tags(counts).select("label_normalized"), paths["common_tags"])
    paths["all_tags"] = out + "user_tags/labels"
    sinks.write_text(counts.select("label_normalized"), paths["all_tags"], files=files)
    paths["tags_images"] = out + "user_tags/labels-images"
    sinks.write_json(tags.select(F.col("image").cast("bigint").alias("id"), F.col("label_normalized").alias("label")),
                     paths["tags_images"], files, order=["id"])
    paths["tag_analysis"] = out + "user_tags/analisis"
    sinks.write_delimited(counts, paths["tag_analysis"], "~", files=files)
    paths["original"] = out + "user_tags/original"
    sinks.write_json(raw.select(F.col("image").cast("bigint").alias("id"), "label"), paths["original"], files, order=["id"])
    _stamp("tags written")
    label_counts = (scores.where(F.col("label") != C.NONE_LABEL).groupBy("label")
                    .agg(F.count(F.lit(1)).alias("count")).persist(StorageLevel.MEMORY_AND_DISK))
    paths["common_labels"] = out + "model_labels/comunes"
    sinks.write_text(T.top_tags(label_counts, "label", "count", C.TOP_TAGS, C.TOP_TAGS, None).select("label"),
                     paths["common_labels"])
    paths["all_labels"] = out + "model_labels/labels"
    sinks.write_text(label_counts.select("label"), paths["all_labels"], files=files)
    paths["unscored"] = out + "model_labels/none"
    sinks.write_text(scores.where(F.col("label") == C.NONE_LABEL).select("image"), paths["unscored"], files=3)
    paths["label_analysis"] = out + "model_labels/analisis"
    sinks.write_delimited(label_counts, paths["label_analysis"], "~", files=files)
    for df in (label_counts, counts, tags, raw):
        df.unpersist()
    _stamp("end")
    return paths


def scoring_job(index: DataFrame, contents: DataFrame, model: DataFrame, dictionary: DataFrame, out_dir: str, key: str = "id",
                n_images: int | None = None, lot_size: int = C.LOT_SIZE, max_labels: int = C.MAX_SCORE_LABELS) -> str:
    """Scores the listed images (the first ``n_images`` in the order of ``key``)
    with their ``max_labels`` best labels, the sentinel if one cannot be scored,
    and writes ``{image, label, score}`` JSON lines.  Lots of ``lot_size`` images
    are dealt to tasks whole, as many lots to a task as there are per task."""
    _stamp("start")
    numbered = SC.numbered(index.select(key), [key], "_number")
    taken = numbered if n_images is None else numbered.where(F.col("_number") < n_images)
    dealt = taken.withColumn("_lot", F.floor(F.col("_number") / lot_size)).repartition("_lot").drop("_number", "_lot")
    scored = SC.classify_images(dealt, contents, model, dictionary, key, max_labels)
    out = scored.select(F.concat(F.lit("im"), F.col(key).cast("string")).alias("image"), "label", "score")
    _stamp("processing")
    sinks.write_json(out, out_dir)
    _stamp("end")
    return out_dir


def inference_job(spark: SparkSession, feature_pairs: DataFrame, target_pairs: DataFrame,
                  target_labels: DataFrame, out_dir: str, binary_features: bool = True,
                  depth: int = C.TREE_DEPTH) -> tuple[str, str]:
    """One-vs-rest forests predicting ``target_labels`` from ``feature_pairs``.

    feature_pairs (id, label[, score]); target_pairs (id, label).  Binary
    bag-of-words features when ``binary_features``, else the pair's score
    over the sorted label vocabulary, in quantile bins.  Writes predictions and statistics."""
    out = _dir(out_dir)
    ids = FE.common_ids(target_pairs, feature_pairs)
    fp = feature_pairs.join(ids, "id", "left_semi")
    if binary_features:
        feats = FE.bag_of_words(fp.select("id", "label"), FE.term_vocabulary(fp.select("id", "label")))
        binned = TR.fixed_bins(feats, TR.BINARY_THRESHOLDS)
    else:
        vocab = SC.numbered(fp.select("label").distinct(), ["label"], "f")
        feats = fp.join(vocab, "label").groupBy("id", "f").agg(F.max("score").alias("v"))
        binned = TR.quantile_bins(feats, ids.where(FE.is_train(F.col("id"))))
    targets = TR.target_list(target_labels)
    images = TR.image_rows(ids, binned, target_pairs, targets)
    preds = TR.predicted_pairs(TR.train(images, targets, depth), images, depth).persist(StorageLevel.MEMORY_AND_DISK)
    pred_path, stats_path = out + "predicciones", out + "estadisticas"
    sinks.write_json(preds, pred_path)
    test_ids = images.where(~F.col("train")).select("id")
    stats = TR.prediction_statistics(preds, target_pairs.join(test_ids, "id", "left_semi"))
    sinks.write_json(stats, stats_path, files=3)
    preds.unpersist()
    return pred_path, stats_path
