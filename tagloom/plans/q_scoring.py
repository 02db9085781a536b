"""Image-scoring queries: model, top-k, sentinel, label counts, index listing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import model_store as MS
from ..operators import scoring as SC
from ..operators import tags as T
from ..sources import tables
from .registry import register

MEAN, SCALE = C.PIXEL_MEAN, C.PIXEL_SCALE

# Centroid model and softmax scores of every embedding, in DuckDB.
SCORES_CTE = f"""
cells AS (SELECT label AS node, i AS pos, (embedding[i + 1]::DOUBLE - {MEAN}) / {SCALE} AS v
          FROM embeddings, range(len(embedding)) t(i) WHERE embedding IS NOT NULL),
centroids AS (SELECT node, pos, avg(v) AS c FROM cells GROUP BY node, pos),
dims AS (SELECT max(cnt) AS dim FROM (SELECT node, count(*) AS cnt FROM centroids GROUP BY node)),
vecs AS (SELECT vec_id, i AS pos, (embedding[i + 1]::DOUBLE - {MEAN}) / {SCALE} AS x
         FROM embeddings, range(len(embedding)) t(i)
         WHERE len(embedding) = (SELECT dim FROM dims)),
logits AS (SELECT v.vec_id, c.node, -sum((v.x - c.c) * (v.x - c.c)) AS logit
           FROM vecs v JOIN centroids c ON v.pos = c.pos GROUP BY v.vec_id, c.node),
expd AS (SELECT vec_id, node, exp(logit - max(logit) OVER (PARTITION BY vec_id)) AS e FROM logits),
probs AS (SELECT vec_id, node, e / sum(e) OVER (PARTITION BY vec_id) AS prob FROM expd),
ranked AS (SELECT vec_id, node, prob,
                  row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, node) AS rank FROM probs),
named AS (SELECT r.*, coalesce(n.n_name, '') AS label FROM ranked r LEFT JOIN nation n ON r.node = n.n_nationkey)"""

# Classification of the page index: pages left join vectors, sentinel when missing.
CLASSIFICATION_CTE = SCORES_CTE + f""",
classification AS (
  SELECT 'im' || p.page_id AS image, n.label, n.prob AS score
  FROM pages p JOIN named n ON n.vec_id = p.page_id WHERE n.rank <= {C.MAX_SCORE_LABELS}
  UNION ALL
  SELECT 'im' || p.page_id, '{C.NONE_LABEL}', {C.NONE_SCORE}
  FROM pages p WHERE p.page_id NOT IN (SELECT vec_id FROM logits))"""


def model(spark, sf_dir):
    """The centroid model of ``embeddings``: fitted once, then loaded by every query."""
    emb = tables.table(spark, sf_dir, "embeddings")
    return MS.stored(spark, "centroids", MS.training_version(emb, MEAN, SCALE),
                     lambda: SC.centroid_model(emb.select("embedding", "label")))


def dictionary(spark, sf_dir):
    return SC.nation_dictionary(tables.table(spark, sf_dir, "nation"))


def classification(spark, sf_dir):
    """(image 'im<page_id>', label, score) for every page of the index."""
    pages = tables.table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"))
    contents = tables.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    scored = SC.classify_images(pages, contents, model(spark, sf_dir), dictionary(spark, sf_dir), "id")
    return scored.select(F.concat(F.lit("im"), F.col("id").cast("string")).alias("image"), "label", "score")


@register("score_topk",
          "WITH " + SCORES_CTE.strip() + f"""
SELECT 'im' || vec_id AS image, rank, label, round(prob, 6) AS score FROM named
WHERE rank <= {C.MAX_SCORE_LABELS}""",
          "M9,S14,W1,O6,O7,J5,F14,X24,P7,D10")
def score_topk_df(spark, sf_dir):
    emb = tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    scored = SC.score_vectors(emb, model(spark, sf_dir), "vec_id")
    named = SC.name_nodes(scored, dictionary(spark, sf_dir))
    return named.select(F.concat(F.lit("im"), F.col("vec_id").cast("string")).alias("image"),
                        F.col("rank").cast("bigint").alias("rank"), "label",
                        F.round("prob", 6).alias("score"))


@register("score_sentinel",
          "WITH " + CLASSIFICATION_CTE.strip() + "\nSELECT image, label, round(score, 6) AS score FROM classification",
          "S6,M9,F14,D6,D9,K6")
def score_sentinel_df(spark, sf_dir):
    c = classification(spark, sf_dir)
    return c.select("image", "label", F.round("score", 6).alias("score"))


@register("label_counts",
          "WITH " + CLASSIFICATION_CTE.strip() + f"""
SELECT label, count(*) AS count FROM classification WHERE label <> '{C.NONE_LABEL}' GROUP BY label""",
          "A3,F1,K4")
def label_counts_df(spark, sf_dir):
    return count_labels(classification(spark, sf_dir))


def count_labels(scores):
    return scores.where(F.col("label") != C.NONE_LABEL).groupBy("label").agg(F.count(F.lit(1)).alias("count"))


@register("label_top50",
          "WITH " + CLASSIFICATION_CTE.strip() + f""",
counts AS (SELECT label, count(*) AS count FROM classification WHERE label <> '{C.NONE_LABEL}' GROUP BY label)
SELECT label, count FROM (SELECT * FROM counts ORDER BY count DESC, label LIMIT {C.TOP_TAGS}) ORDER BY label""",
          "O2,A3,F1,D2")
def label_top50_df(spark, sf_dir):
    counts = label_counts_df(spark, sf_dir)
    return T.top_tags(counts, label="label", count="count", n=C.TOP_TAGS, prefilter=C.TOP_TAGS, exclude=None)


@register("unscored_images",
          "WITH " + CLASSIFICATION_CTE.strip() + f"\nSELECT image FROM classification WHERE label = '{C.NONE_LABEL}'",
          "F2,K1")
def unscored_images_df(spark, sf_dir):
    return classification(spark, sf_dir).where(F.col("label") == C.NONE_LABEL).select("image")


# ---- HTML index listing ----------------------------------------------------

LISTING_SQL = f"""
SELECT page_id, pos, name, url || '/' || name AS image_url,
       (row_number() OVER (ORDER BY page_id, pos) - 1) // {C.LOT_SIZE} AS lot FROM (
  SELECT page_id, url, pos, string_split(string_split(piece, '<')[2], '>')[2] AS name
  FROM (SELECT page_id, url, unnest(string_split(html, '<li>')) AS piece,
               generate_subscripts(string_split(html, '<li>'), 1) - 1 AS pos FROM pages))
WHERE pos >= 2 AND name IS NOT NULL"""


def page_items(pages):
    """(page_id, url, items): the items of each page's ``<li>`` list after the
    first one, as (pos, name); link text = text between the first '>' and the next
    '<' of the item."""
    def item(piece, i):
        return F.struct(i.cast("bigint").alias("pos"), F.get(F.split(F.get(F.split(piece, "<"), 1), ">"), 1).alias("name"))
    items = F.filter(F.transform(F.split("html", "<li>"), item), lambda x: (x["pos"] >= 2) & x["name"].isNotNull())
    return pages.select("page_id", "url", items.alias("items"))


def listing_of(pages):
    """(page_id, pos, name, image_url) of every item."""
    items = page_items(pages).select("page_id", "url", F.explode_outer("items").alias("item")).where("item is not null")
    return items.select("page_id", "item.pos", "item.name", F.concat("url", F.lit("/"), "item.name").alias("image_url"))


def _pages(spark, sf_dir):
    return tables.table(spark, sf_dir, "pages").select("page_id", "url", "html")


def listing(spark, sf_dir):
    return listing_of(_pages(spark, sf_dir))


def lots(pages, n: int | None = None, lot_size: int = C.LOT_SIZE):
    """(page_id, pos, name, lot): the listing in lots of ``lot_size`` items, counted
    over the whole listing in the order of (page_id, pos); the first ``n`` items if
    given.  Only pages are sorted: an item's number is that of the items of the
    pages before its own and its place in its page."""
    counted = page_items(pages).select("page_id", "items", F.size("items").alias("_size"))
    numbered = SC.running_total(counted, ["page_id"], "_size", "_before")
    items = (numbered.select("page_id", "_before", F.posexplode_outer("items").alias("_place", "item")).where("item is not null")
             .select("page_id", "item.pos", "item.name", (F.col("_before") + F.col("_place")).alias("_number")))
    taken = items if n is None else items.where(F.col("_number") < n)
    return taken.withColumn("lot", F.floor(F.col("_number") / lot_size).cast("bigint")).drop("_number")


@register("index_listing", "SELECT page_id, pos, name, image_url FROM (" + LISTING_SQL + ")", "S5,O10,X23,X3")
def index_listing_df(spark, sf_dir):
    return listing(spark, sf_dir).select("page_id", "pos", "name", "image_url")


@register("image_lots",
          "SELECT page_id, lot, count(*) AS n_images, min(pos) AS first_pos FROM (" + LISTING_SQL + ") GROUP BY page_id, lot",
          "W2")
def image_lots_df(spark, sf_dir):
    return (lots(_pages(spark, sf_dir)).groupBy("page_id", "lot")
            .agg(F.count(F.lit(1)).alias("n_images"), F.min("pos").alias("first_pos")))


# ---- listing -> lots -> scores ----------------------------------------------

# A listed name has content if the vector that its characters name exists; the
# key range is a quarter wider than the ids, so some names have none.
LISTED_KEY_SQL = "((page_id * 31 + pos) % (n + n // 4 + 1))"

LISTED_SQL = ("WITH " + SCORES_CTE.strip() + f""",
listed AS (SELECT page_id, pos, name, lot, {LISTED_KEY_SQL} AS k
           FROM ({LISTING_SQL}), (SELECT coalesce(max(vec_id), 0) + 1 AS n FROM embeddings))
SELECT l.page_id, l.pos, l.name, l.lot, coalesce(n.label, '{C.NONE_LABEL}') AS label,
       round(coalesce(n.prob, {C.NONE_SCORE}), 6) AS score
FROM listed l LEFT JOIN named n ON n.vec_id = l.k AND n.rank <= {C.MAX_SCORE_LABELS}""")


@register("listed_image_scores", LISTED_SQL, "S5,W2,S6,M9,O10,F14")
def listed_image_scores_df(spark, sf_dir):
    contents = tables.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("k"), "embedding")
    n = (contents.agg(F.max("k")).first()[0] or 0) + 1
    items = lots(_pages(spark, sf_dir)).withColumn("k", F.pmod(F.col("page_id") * 31 + F.col("pos"), F.lit(n + n // 4 + 1)))
    keys = items.select("k").distinct()
    scored = SC.classify_images(keys, contents, model(spark, sf_dir), dictionary(spark, sf_dir), "k")
    return (items.join(scored, "k").select("page_id", "pos", "name", "lot", "label", F.round("score", 6).alias("score")))


# ---- label vocabulary and score features -----------------------------------

@register("label_vocabulary",
          "WITH " + CLASSIFICATION_CTE.strip() + """
SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx, count(*) OVER () AS n_labels
FROM (SELECT DISTINCT label FROM classification)""",
          "A8,O4,J7")
def label_vocabulary_df(spark, sf_dir):
    return label_vocabulary(classification(spark, sf_dir))


def label_vocabulary(scores):
    """Sorted distinct labels with their 0-based position.  The window runs
    over the distinct label set only (bounded by the model's classes)."""
    labels = scores.select("label").distinct()
    return (labels.withColumn("idx", (F.row_number().over(Window.orderBy("label")) - 1).cast("bigint"))
            .withColumn("n_labels", F.count(F.lit(1)).over(Window.partitionBy()).cast("bigint")))


@register("score_features",
          "WITH " + CLASSIFICATION_CTE.strip() + """,
vocab AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM classification))
SELECT CAST(substr(c.image, 3) AS BIGINT) AS imagen, v.idx, round(max(c.score), 6) AS score
FROM classification c JOIN vocab v USING (label) GROUP BY imagen, v.idx""",
          "M2,X22,A5,J7,X2,D3,D4")
def score_features_df(spark, sf_dir):
    return score_features(classification(spark, sf_dir)).withColumn("score", F.round("score", 6))


def score_features(scores):
    """Sparse score vector in long form (imagen, idx, score); a repeated
    label on one image keeps its highest score."""
    vocab = label_vocabulary(scores).select("label", "idx")
    from ..functions import text as X
    return (scores.join(F.broadcast(vocab), "label")
            .groupBy(X.image_number(F.col("image")).alias("imagen"), "idx")
            .agg(F.max("score").alias("score")))


@register("dashboard_totals",
          "WITH " + CLASSIFICATION_CTE.strip() + f"""
SELECT (SELECT count(*) FROM (SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) FROM documents)) AS n_original_tags,
       (SELECT count(DISTINCT image) FROM classification) AS n_images,
       (SELECT label FROM (SELECT label, count(*) AS c FROM classification WHERE label <> '{C.NONE_LABEL}'
                           GROUP BY label ORDER BY c DESC, label LIMIT 1)) AS top_label,
       (SELECT format('{{:,}}', count(*)) FROM (SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) FROM documents)) AS n_original_tags_text""",
          "A10,A11,O8,X18,F12")
def dashboard_totals_df(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = T.lines_from_text(docs, "doc_id", "text")
    c = SC.materialize(classification(spark, sf_dir), "scores")
    n_tags = lines.agg(F.count(F.lit(1)).alias("n_original_tags"))
    n_img = c.agg(F.count_distinct("image").alias("n_images"))
    top = T.most_frequent(count_labels(c), "label", "count").select(F.col("label").alias("top_label"))
    out = n_tags.withColumn("_k", F.lit(0)).join(n_img.withColumn("_k", F.lit(0)), "_k") \
        .join(top.withColumn("_k", F.lit(0)), "_k", "left")
    return out.select("n_original_tags", "n_images", "top_label",
                      F.format_number(F.col("n_original_tags"), 0).alias("n_original_tags_text"))


# ---- Arrow-batched scorer (predict_batch_udf) --------------------------------

def batch_scorer(model_df, batch_size: int = C.LOT_SIZE):
    """``predict_batch_udf`` returning the class probabilities of a vector.

    The centroids are a bounded model (classes x dim, checked) shipped inside
    the loader closure, like a broadcast model file; scoring is vectorised
    numpy over Arrow batches of ``batch_size`` rows (the reference's lots)."""
    import numpy as np
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as TT

    row = SC.model_row(model_df).first()
    classes = sorted(row["classes"], key=lambda c: c["node"])
    centroids = np.array([c["centroid"] for c in classes], dtype=np.float64)

    def make_predict_fn():
        cents = centroids

        def predict(x):
            v = (x.astype(np.float64) - MEAN) / SCALE
            d2 = ((v[:, None, :] - cents[None, :, :]) ** 2).sum(axis=2)
            logits = -d2
            logits -= logits.max(axis=1, keepdims=True)
            e = np.exp(logits)
            return e / e.sum(axis=1, keepdims=True)
        return predict

    nodes = [int(c["node"]) for c in classes]
    udf = predict_batch_udf(make_predict_fn, return_type=TT.ArrayType(TT.DoubleType()),
                            batch_size=batch_size, input_tensor_shapes=[[centroids.shape[1]]])
    return udf, nodes, centroids.shape[1] if len(nodes) else 0


@register("score_batch_udf",
          "WITH " + SCORES_CTE.strip() + f"""
SELECT 'im' || vec_id AS image, rank, label, round(prob, 6) AS score FROM named
WHERE rank <= {C.MAX_SCORE_LABELS}""",
          "M9,V3,S14,W1 (Arrow batches)")
def score_batch_udf_df(spark, sf_dir):
    emb = tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return batch_scored(emb, model(spark, sf_dir), dictionary(spark, sf_dir))


def batch_scored(emb, model_df, names):
    """(image, rank, label, score); vectors that the model cannot score (null, of
    another length, with a null or a NaN) get no rows, as in ``score_vectors``."""
    udf, nodes, dim = batch_scorer(model_df)
    node_arr = F.array(*[F.lit(n) for n in nodes])
    probs = F.zip_with(node_arr, F.col("p"), lambda n, p: F.struct(n.alias("node"), p.alias("prob")))
    scored = (emb.where(SC.valid_vector(F.col("embedding"), F.lit(dim))).withColumn("p", udf(F.col("embedding")))
              .select("vec_id", F.posexplode(SC.top_k(probs, C.MAX_SCORE_LABELS)).alias("pos", "t"))
              .select("vec_id", (F.col("pos") + 1).cast("bigint").alias("rank"), F.col("t.node").alias("node"),
                      F.col("t.prob").alias("prob")))
    named = SC.name_nodes(scored, names)
    return named.select(F.concat(F.lit("im"), F.col("vec_id").cast("string")).alias("image"), "rank", "label",
                        F.round("prob", 6).alias("score"))
