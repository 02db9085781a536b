"""Cross-vocabulary label inference: tags -> model labels and back.

Forests of depth 1 and 8 (the job's setting) are checked against SQL; the MLlib
path is a cross-check on rows only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as X
from ..operators import features as FE
from ..operators import tags as T
from ..operators import trees as TR
from ..session import materialize, scratch_path
from ..sources import standins
from . import q_scoring as QS
from . import sql_text as S
from .q_tags import LINES_SQL, _not_in
from .registry import register

# ---- Spark side -------------------------------------------------------------


def normalized_tags(spark, sf_dir):
    """Processed tags, materialised once per query (the job reads them for
    features, targets and statistics)."""
    return materialize(T.normalized_tags(standins.tag_lines(spark, sf_dir)), "processed-tags")


def tag_pairs(spark, sf_dir, tags=None):
    tags = normalized_tags(spark, sf_dir) if tags is None else tags
    return tags.select(F.col("image").alias("id"), F.col("label_normalized").alias("label"))


def model_pairs(spark, sf_dir, keep_sentinel: bool = True):
    c = QS.classification(spark, sf_dir)
    if not keep_sentinel:
        c = c.where(F.col("label") != C.NONE_LABEL)
    return c.select(X.image_number(F.col("image")).alias("id"), "label")


def scores_once(spark, sf_dir):
    """Page classification, materialised once per query (truth, target list
    and features all read it)."""
    return materialize(QS.classification(spark, sf_dir), "scores")


def top_model_labels(scores):
    counts = scores.where(F.col("label") != C.NONE_LABEL).groupBy("label").agg(F.count(F.lit(1)).alias("count"))
    return T.top_tags(counts, label="label", count="count", n=C.TOP_TAGS, prefilter=C.TOP_TAGS, exclude=None)


def direction_tags_to_labels(spark, sf_dir):
    """(features, truth, target labels, vocabulary, ids) with user tags as
    features, model labels as targets."""
    scores = scores_once(spark, sf_dir)
    tags = tag_pairs(spark, sf_dir)
    labels = scores.select(X.image_number(F.col("image")).alias("id"), "label")
    # The tags of common images, found once for the vocabulary, the features and the ids.
    tags_j = materialize(tags.join(labels.select("id").distinct(), "id", "left_semi"), "common-tags")
    ids = materialize(FE.common_ids(labels, tags_j), "common-ids")
    vocab = FE.term_vocabulary(tags_j)
    return FE.bag_of_words(tags_j, vocab), labels, top_model_labels(scores).select("label"), vocab, ids


def direction_labels_to_tags(spark, sf_dir):
    """The same with model scores as features, user tags as targets."""
    processed = normalized_tags(spark, sf_dir)
    tags = tag_pairs(spark, sf_dir, processed)
    scores = scores_once(spark, sf_dir)
    labels = scores.select(X.image_number(F.col("image")).alias("id"), "label")
    ids = materialize(FE.common_ids(labels, tags), "common-ids")
    feats = (QS.score_features(scores)
             .select(F.col("imagen").alias("id"), F.col("idx").alias("f"), F.col("score").alias("v"))
             .join(ids, "id", "left_semi"))
    top = T.top_tags(T.tag_counts(processed)).select(F.col("label_normalized").alias("label"))
    return feats, tags, top, None, ids


def forest_predictions(spark, sf_dir, direction, depth, quantiles: bool = False):
    """(predicted pairs, truth, image rows)."""
    feats, truth, top, _, ids = direction(spark, sf_dir)
    if quantiles:
        binned = TR.quantile_bins(feats, ids.where(FE.is_train(F.col("id"))))
    else:
        binned = TR.fixed_bins(feats, TR.BINARY_THRESHOLDS if direction is direction_tags_to_labels else TR.SCORE_THRESHOLDS)
    targets = TR.target_list(top)
    images = TR.image_rows(ids, binned, truth, targets)
    forest = TR.train(images, targets, depth)
    return TR.predicted_pairs(forest, images, depth), truth, images


def statistics(spark, sf_dir, direction, depth):
    predicted, truth, images = forest_predictions(spark, sf_dir, direction, depth)
    test_ids = images.where(~F.col("train")).select("id")
    return TR.prediction_statistics(predicted, truth.join(test_ids, "id", "left_semi"))


# ---- SQL side ---------------------------------------------------------------

def _bucket(col: str) -> str:
    return f"((({col} % {FE.SPLIT_MODULUS}) * {FE.SPLIT_MULTIPLIER} + {FE.SPLIT_OFFSET}) % 100)"


BASE_CTE = ("WITH RECURSIVE " + S.normalized_tags_cte(LINES_SQL).strip() + ",\n"
            + QS.CLASSIFICATION_CTE.strip() + f""",
tag_pairs AS (SELECT image AS id, label_normalized AS label FROM tags),
model_pairs AS (SELECT CAST(substr(image, 3) AS BIGINT) AS id, label FROM classification),
ids AS (SELECT id FROM (SELECT DISTINCT id FROM model_pairs) JOIN (SELECT DISTINCT id FROM tag_pairs) USING (id)),
tag_counts AS (SELECT label_normalized, count(*) AS tag_count FROM tags GROUP BY label_normalized),
tag_top AS (SELECT label_normalized AS label FROM (
  SELECT * FROM (SELECT * FROM tag_counts ORDER BY tag_count DESC, label_normalized LIMIT {C.TOP_TAGS_PREFILTER})
  WHERE label_normalized NOT IN {_not_in(C.NON_SIGNIFICANT_TAGS)}
  ORDER BY tag_count DESC, label_normalized LIMIT {C.TOP_TAGS})),
label_top AS (SELECT label FROM (SELECT label, count(*) AS c FROM classification WHERE label <> '{C.NONE_LABEL}'
              GROUP BY label ORDER BY c DESC, label LIMIT {C.TOP_TAGS})),
tags_j AS (SELECT * FROM tag_pairs WHERE id IN (SELECT id FROM ids)),
vocab AS (SELECT label, row_number() OVER (ORDER BY tf DESC, label) - 1 AS f FROM (
  SELECT label, count(*) AS tf FROM tags_j GROUP BY label ORDER BY tf DESC, label LIMIT {C.VOCAB_SIZE})),
feat_a AS (SELECT id, f, CAST(count(*) AS DOUBLE) AS v FROM tags_j JOIN vocab USING (label) GROUP BY id, f),
tgt_a AS (SELECT l.label AS target, i.id, CASE WHEN p.id IS NULL THEN 0 ELSE 1 END AS y,
                 {_bucket('i.id')} < {C.TRAIN_PERCENT} AS train
          FROM ids i CROSS JOIN label_top l
          LEFT JOIN (SELECT DISTINCT id, label FROM model_pairs) p ON p.id = i.id AND p.label = l.label),
lvocab AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM classification)),
feat_b AS (SELECT CAST(substr(c.image, 3) AS BIGINT) AS id, v.idx AS f, max(c.score) AS v
           FROM classification c JOIN lvocab v USING (label)
           WHERE CAST(substr(c.image, 3) AS BIGINT) IN (SELECT id FROM ids) GROUP BY 1, 2),
tgt_b AS (SELECT l.label AS target, i.id, CASE WHEN p.id IS NULL THEN 0 ELSE 1 END AS y,
                 {_bucket('i.id')} < {C.TRAIN_PERCENT} AS train
          FROM ids i CROSS JOIN tag_top l
          LEFT JOIN (SELECT DISTINCT id, label FROM tag_pairs) p ON p.id = i.id AND p.label = l.label)""")


def _gini(n: str, n1: str) -> str:
    p = f"(CAST({n1} AS DOUBLE) / CAST({n} AS DOUBLE))"
    return f"(1.0 - {p} * {p} - (1.0 - {p}) * (1.0 - {p}))"


def level_cte(p: str, level: int, feat: str, thresholds: list[float]) -> str:
    """One level of a forest: ``{p}_n{level}`` -> ``{p}_n{level + 1}``, tables of
    (target, id, y, train, node), mirroring trees.py."""
    tl = "[" + ", ".join(repr(float(t)) for t in thresholds) + "]"
    bin_expr = " + ".join(f"(CASE WHEN f.v > {float(t)!r} THEN 1 ELSE 0 END)" for t in thresholds)
    q, tgt = f"{p}{level}", f"{p}_n{level}"
    over = "OVER (PARTITION BY target, node, f ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f""",
{q}_active AS (SELECT * FROM {tgt} WHERE train AND node >= {2 ** level}),
{q}_stats AS (SELECT target, node, count(*) AS n, sum(y) AS n1 FROM {q}_active GROUP BY target, node),
{q}_binned AS (SELECT target, node, f, bin, count(*) AS c, sum(y) AS c1 FROM (
    SELECT t.target, t.node, f.f, t.y, {bin_expr} AS bin FROM {q}_active t JOIN {feat} f ON t.id = f.id)
  WHERE bin >= 1 GROUP BY target, node, f, bin),
{q}_cum AS (SELECT target, node, f, bin, sum(c) {over} AS nr, sum(c1) {over} AS nr1,
    coalesce(lead(bin) OVER (PARTITION BY target, node, f ORDER BY bin DESC), 0) AS prev_bin FROM {q}_binned),
{q}_cand AS (SELECT c.target, c.node, c.f, c.prev_bin, s.n, s.n1, c.nr, c.nr1, s.n - c.nr AS nl, s.n1 - c.nr1 AS nl1
  FROM {q}_cum c JOIN {q}_stats s USING (target, node)),
{q}_gain AS (SELECT target, node, f, {tl}[prev_bin + 1] AS t,
    round({_gini('n', 'n1')} - nl / n * {_gini('nl', 'nl1')} - nr / n * {_gini('nr', 'nr1')}, {TR.GAIN_DECIMALS}) AS gain
  FROM {q}_cand WHERE nr >= 1 AND nl >= 1),
{q}_best AS (SELECT target, node, f, t FROM (
    SELECT *, row_number() OVER (PARTITION BY target, node ORDER BY gain DESC, f, t) AS rn FROM {q}_gain WHERE gain > 0)
  WHERE rn = 1),
{p}_n{level + 1} AS MATERIALIZED (SELECT t.target, t.id, t.y, t.train,
    CASE WHEN b.f IS NULL THEN t.node ELSE 2 * t.node + CAST(coalesce(fv.v, 0.0) > b.t AS INTEGER) END AS node
  FROM {tgt} t LEFT JOIN {q}_best b ON b.target = t.target AND b.node = t.node
  LEFT JOIN {feat} fv ON fv.id = t.id AND fv.f = b.f)"""


def forest_cte(p: str, tgt: str, feat: str, thresholds: list[float], depth: int) -> str:
    """CTEs ``{p}_pred(id, label)`` of a forest of the given depth."""
    levels = "".join(level_cte(p, level, feat, thresholds) for level in range(depth))
    return f""",
{p}_n0 AS MATERIALIZED (SELECT target, id, y, train, 1 AS node FROM {tgt}){levels},
{p}_leaves AS (SELECT target, node, CASE WHEN sum(y) * 2 > count(*) THEN 1 ELSE 0 END AS prediction
  FROM {p}_n{depth} WHERE train GROUP BY target, node),
{p}_pred AS (SELECT a.id, a.target AS label FROM {p}_n{depth} a JOIN {p}_leaves l USING (target, node)
  WHERE NOT a.train AND l.prediction = 1)"""


# Scores in bins of equal shares of the training rows (trees.quantile_thresholds);
# the bin takes the place of the score.
QUANTILE_CTE = f""",
q_rows AS (SELECT count(*) AS total FROM ids WHERE {_bucket('id')} < {C.TRAIN_PERCENT}),
q_cells AS (SELECT f, CAST(ceil(v * {TR.SCORE_CELLS}) AS BIGINT) AS cell, count(*) AS n FROM feat_b
            WHERE {_bucket('id')} < {C.TRAIN_PERCENT} GROUP BY 1, 2),
q_all AS (SELECT f, cell, sum(n) AS n FROM (SELECT * FROM q_cells UNION ALL
          SELECT f, 0, any_value(total) - sum(n) FROM q_cells, q_rows GROUP BY f) GROUP BY f, cell),
q_upto AS (SELECT f, cell, n, sum(n) OVER (PARTITION BY f ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
           FROM q_all),
q_thresholds AS (SELECT f, cell FROM q_upto, q_rows
                 WHERE least({TR.QUANTILES - 1}, upto * {TR.QUANTILES} // total)
                       > least({TR.QUANTILES - 1}, (upto - n) * {TR.QUANTILES} // total)),
feat_q AS (SELECT id, f, CAST(count(*) AS DOUBLE) AS v FROM feat_b JOIN q_thresholds USING (f)
           WHERE cell < ceil(v * {TR.SCORE_CELLS}) GROUP BY id, f)"""
BIN_THRESHOLDS = [b + 0.5 for b in range(TR.QUANTILES - 1)]


def _quantile_sql(depth: int) -> str:
    return (BASE_CTE + QUANTILE_CTE + forest_cte("q", "tgt_b", "feat_q", BIN_THRESHOLDS, depth)
            + "\nSELECT id, label FROM q_pred")


def _forests(depth: int) -> tuple[str, str]:
    """SQL up to the predictions of both directions."""
    return (BASE_CTE + forest_cte("a", "tgt_a", "feat_a", TR.BINARY_THRESHOLDS, depth),
            BASE_CTE + forest_cte("b", "tgt_b", "feat_b", TR.SCORE_THRESHOLDS, depth))


A_CTE, B_CTE = _forests(1)
A8_CTE, B8_CTE = _forests(C.TREE_DEPTH)


def _stats_sql(p: str, tgt: str, truth: str) -> str:
    return f""",
{p}_truth AS (SELECT DISTINCT id, label FROM {truth} WHERE id IN (SELECT id FROM {tgt} WHERE NOT train)),
{p}_n_images AS (SELECT label, count(*) AS num_images FROM {p}_truth GROUP BY label),
{p}_n_pred AS (SELECT label, count(*) AS num_predicciones FROM (SELECT DISTINCT id, label FROM {p}_pred) GROUP BY label),
{p}_hits AS (SELECT label, count(*) AS aciertos FROM {p}_truth t
             WHERE EXISTS (SELECT 1 FROM {p}_pred q WHERE q.id = t.id AND q.label = t.label) GROUP BY label),
{p}_statsout AS (SELECT label, num_images, num_predicciones, coalesce(aciertos, 0) AS aciertos
  FROM {p}_n_pred JOIN {p}_n_images USING (label) LEFT JOIN {p}_hits USING (label))"""


# ---- registry ---------------------------------------------------------------

@register("train_test_split",
          BASE_CTE + f"\nSELECT id, {_bucket('id')} < {C.TRAIN_PERCENT} AS train FROM ids", "M3,D1,J1")
def train_test_split_df(spark, sf_dir):
    ids = FE.common_ids(model_pairs(spark, sf_dir), tag_pairs(spark, sf_dir))
    return ids.select("id", FE.is_train(F.col("id")).alias("train"))


@register("bag_of_words", BASE_CTE + "\nSELECT id, label AS term, f, v FROM feat_a JOIN vocab USING (f)",
          "M1,A15,J1,A4,P4")
def bag_of_words_df(spark, sf_dir):
    feats, _, _, vocab, _ = direction_tags_to_labels(spark, sf_dir)
    return feats.join(F.broadcast(vocab), "f").select("id", F.col("label").alias("term"), "f", "v")


@register("one_vs_rest", BASE_CTE + "\nSELECT target, id, y, train FROM tgt_a", "J10,M4,X21,P11,D5")
def one_vs_rest_df(spark, sf_dir):
    _, truth, top, _, ids = direction_tags_to_labels(spark, sf_dir)
    return FE.targets_table(ids, truth, top)


@register("infer_labels_from_tags", A_CTE + "\nSELECT id, label FROM a_pred", "J1,M6,A16,M7,F6,P10,U1 (depth 1)")
def infer_labels_from_tags_df(spark, sf_dir):
    return forest_predictions(spark, sf_dir, direction_tags_to_labels, 1)[0]


@register("infer_tags_from_labels", B_CTE + "\nSELECT id, label FROM b_pred", "J2,M2,M6,A16,M7,F6,U1 (depth 1)")
def infer_tags_from_labels_df(spark, sf_dir):
    return forest_predictions(spark, sf_dir, direction_labels_to_tags, 1)[0]


@register("prediction_stats",
          A_CTE + _stats_sql("a", "tgt_a", "model_pairs") + "\nSELECT * FROM a_statsout",
          "A6,A9,J3,J4,U3,M8,P6 (depth 1)")
def prediction_stats_df(spark, sf_dir):
    return statistics(spark, sf_dir, direction_tags_to_labels, 1)


@register("hit_rate",
          B_CTE + _stats_sql("b", "tgt_b", "tag_pairs") + """
SELECT substr(label, 1, 25) AS label25, label,
       floor(CAST(aciertos AS DOUBLE) / CAST(num_images AS DOUBLE) * 10000 + 0.5) / 100 AS tasa,
       min(floor(CAST(aciertos AS DOUBLE) / CAST(num_images AS DOUBLE) * 10000 + 0.5) / 100) OVER () AS min_tasa,
       max(floor(CAST(aciertos AS DOUBLE) / CAST(num_images AS DOUBLE) * 10000 + 0.5) / 100) OVER () AS max_tasa
FROM b_statsout""",
          "X14,X16,A12,M8 (depth 1)")
def hit_rate_df(spark, sf_dir):
    st = statistics(spark, sf_dir, direction_labels_to_tags, 1)
    rated = st.select(F.substring("label", 1, 25).alias("label25"), "label",
                      X.hit_rate(F.col("aciertos"), F.col("num_images")).alias("tasa"))
    bounds = rated.agg(F.min("tasa").alias("min_tasa"), F.max("tasa").alias("max_tasa")).withColumn("_k", F.lit(0))
    return rated.withColumn("_k", F.lit(0)).join(F.broadcast(bounds), "_k").drop("_k")


@register("infer_labels_from_tags_depth8", A8_CTE + "\nSELECT id, label FROM a_pred", "M5,M6 depth 8,M7,U1")
def infer_labels_depth8_df(spark, sf_dir):
    return forest_predictions(spark, sf_dir, direction_tags_to_labels, C.TREE_DEPTH)[0]


@register("infer_tags_from_labels_depth8", B8_CTE + "\nSELECT id, label FROM b_pred", "M5,M6 depth 8,M7,U1")
def infer_tags_depth8_df(spark, sf_dir):
    return forest_predictions(spark, sf_dir, direction_labels_to_tags, C.TREE_DEPTH)[0]


@register("prediction_stats_depth8", A8_CTE + _stats_sql("a", "tgt_a", "model_pairs") + "\nSELECT * FROM a_statsout",
          "A9,M8 on depth-8 forests")
def prediction_stats_depth8_df(spark, sf_dir):
    return statistics(spark, sf_dir, direction_tags_to_labels, C.TREE_DEPTH)


@register("infer_tags_quantile_bins", _quantile_sql(1), "M5 (quantile bins),M2,M6 (depth 1)")
def infer_tags_quantile_df(spark, sf_dir):
    return forest_predictions(spark, sf_dir, direction_labels_to_tags, 1, True)[0]


@register("infer_tags_quantile_bins_depth8", _quantile_sql(C.TREE_DEPTH), "M5 (quantile bins),M2,M6 depth 8")
def infer_tags_quantile_depth8_df(spark, sf_dir):
    return forest_predictions(spark, sf_dir, direction_labels_to_tags, C.TREE_DEPTH, True)[0]


# ---- MLlib path (M5): one DecisionTreeClassifier per target, as the reference ----

def sparse_vectors(features, size: int):
    """(id, f, v) -> (id, features): one sparse vector per image, from a grouped
    aggregate of its indices and values in order."""
    from pyspark.ml.linalg import Vectors, VectorUDT

    cells = features.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("f", "v"))).alias("x"))
    to_vector = F.udf(lambda x: Vectors.sparse(size, [c["f"] for c in x], [c["v"] for c in x]), VectorUDT())
    return cells.select("id", to_vector("x").alias("features"))


FITS_AT_ONCE = 4


def mllib_fits(vectors, ids, truth, targets: list[str], max_depth: int = C.TREE_DEPTH):
    """Positive test predictions (id, label) of one Gini tree per target (at most
    TOP_TAGS, ``FITS_AT_ONCE`` fitted side by side, so that the many short jobs of a
    fit do not leave cores idle).  The images are persisted for the fits; the
    predictions are stored before they are released.  A fit reads them in one task a
    core, as each task shuffles the counts of all features for every node of a level."""
    from multiprocessing.pool import ThreadPool

    from pyspark import StorageLevel, inheritable_thread_target
    from pyspark.ml.classification import DecisionTreeClassifier

    labels = truth.groupBy("id").agg(F.collect_set("label").alias("classification"))
    data = (ids.select("id").distinct().join(labels, "id").join(vectors, "id")
            .withColumn("train", FE.is_train(F.col("id"))).persist(StorageLevel.MEMORY_AND_DISK))
    train, test = data.where("train").coalesce(data.sparkSession.sparkContext.defaultParallelism), data.where(~F.col("train"))
    out = data.sparkSession.createDataFrame([], data.select("id", F.lit("").alias("label")).schema)

    def fit(target):
        y = F.array_contains("classification", target).cast("double")
        return DecisionTreeClassifier(labelCol="y", featuresCol="features", impurity="gini", maxDepth=max_depth, seed=7).fit(train.withColumn("y", y))
    data.count()  # the cache is filled once, before several fits read it
    with ThreadPool(FITS_AT_ONCE) as pool:
        models = pool.map(inheritable_thread_target(data.sparkSession)(fit), targets[:C.TOP_TAGS], chunksize=1)
    for target, model in zip(targets, models):
        out = out.unionByName(model.transform(test).where(F.col("prediction") == 1.0).select("id", F.lit(target).alias("label")))
    out = materialize(out, "mllib-predictions")
    data.unpersist()
    return out


def mllib_predictions(spark, sf_dir, max_depth: int = C.TREE_DEPTH):
    """Tags to labels, over CountVectorizer features of each image's tags.  Both sides
    are stored once, so that no fit's plan holds how they are made."""
    from pyspark.ml.feature import CountVectorizer

    labels = materialize(model_pairs(spark, sf_dir), "model-pairs")
    tags = T.image_tags(standins.tag_lines(spark, sf_dir)).withColumnRenamed("image", "id")
    path = scratch_path(spark, "image-tags")
    tags.join(labels.select("id").distinct(), "id").write.parquet(path)
    per_image = spark.read.parquet(path)
    cv = CountVectorizer(inputCol="labels", outputCol="features", vocabSize=C.VOCAB_SIZE).fit(per_image)
    targets = [r["label"] for r in QS.label_top50_df(spark, sf_dir).select("label").limit(C.TOP_TAGS).collect()]
    return mllib_fits(cv.transform(per_image).select("id", "features"), per_image, labels, targets, max_depth)


def mllib_tag_predictions(spark, sf_dir, max_depth: int = C.TREE_DEPTH, n_targets: int = C.TOP_TAGS):
    """The mirrored direction: labels to tags, over sparse vectors of the scores.
    Also gives the own forest's predictions of the same targets."""
    feats, truth, top, _, ids = direction_labels_to_tags(spark, sf_dir)
    feats = materialize(feats, "score-features")
    targets = TR.target_list(top)[:n_targets]
    size = 1 + (feats.agg(F.max("f")).first()[0] or 0)
    theirs = mllib_fits(sparse_vectors(feats, size), ids, truth, targets, max_depth)
    images = TR.image_rows(ids, TR.quantile_bins(feats, ids.where(FE.is_train(F.col("id")))), truth, targets)
    return theirs, TR.predicted_pairs(TR.train(images, targets, max_depth), images, max_depth)


@register("mllib_tree_predictions", None, "M5,M7,F6,U1,K9 (MLlib, rows only)")
def mllib_tree_predictions_df(spark, sf_dir):
    return mllib_predictions(spark, sf_dir)
