"""Streaming queries: each runs a real Structured Streaming job (availableNow)
over a post feed derived from ``events`` and returns what its sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import scoring as SC
from ..session import scratch_path
from ..sources import tables
from ..streaming import posts as P
from ..streaming import recent as R
from . import q_scoring as QS
from .registry import register

POSTS_CTE = f"""
posts AS (SELECT event_id AS id, ts,
                 concat_ws(' ', event_type, CASE WHEN value > 50 THEN 'photo' ELSE 'post' END, props) AS text,
                 CASE WHEN event_type = 'error' THEN 'video' ELSE 'photo' END AS p_type,
                 '{P.IMAGE_HOST}' || CASE WHEN user_id % 3 = 0 THEN 'tweet_video_thumb/' ELSE '' END
                   || 'im' || (event_id % n) || '.jpg' AS p_url,
                 event_type IN ('view', 'purchase') AS has_ext,
                 '{P.IMAGE_HOST}ext/im' || ((event_id * 7 + 3) % (n + n // 8 + 1)) || '.jpg' AS e_url
          FROM events, (SELECT coalesce(max(vec_id), 0) + 1 AS n FROM embeddings)),
kw AS (SELECT * FROM posts WHERE regexp_matches(lower(text), '\\bphoto\\b')),
urls AS (SELECT id, ts, p_url AS url FROM kw WHERE p_type = 'photo' AND contains(p_url, 'tweet_video_thumb')
         UNION ALL SELECT id, ts, e_url FROM kw WHERE has_ext)"""

STREAM_CTE = "WITH " + QS.SCORES_CTE.strip() + "," + POSTS_CTE + f""",
keyed AS (SELECT id, url, TRY_CAST(string_split(string_split(string_split(url, '/')[-1], '.')[1], 'im')[2] AS BIGINT) AS k
          FROM urls),
srows AS (SELECT u.id, u.url, n.rank, n.label, n.prob FROM keyed u JOIN named n ON n.vec_id = u.k
          WHERE n.rank <= {C.STREAM_LABELS}),
lines AS (SELECT url, label, CAST(printf('%.2f', prob * 100) AS DOUBLE) AS pct, id FROM srows)"""


def _feed(spark, sf_dir) -> str:
    """Writes the post feed (JSON files) derived from ``events``."""
    path = scratch_path(spark, "posts")
    _posts(spark, sf_dir).write.mode("overwrite").json(path)
    return path


def _posts(spark, sf_dir):
    return P.posts_from_events(tables.table(spark, sf_dir, "events"), tables.table(spark, sf_dir, "embeddings"))


def _static_inputs(spark, sf_dir):
    contents = tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return contents, SC.model_row(QS.model(spark, sf_dir)), QS.dictionary(spark, sf_dir)


def _run_classification(spark, sf_dir) -> str:
    feed = _feed(spark, sf_dir)
    contents, model_row, dictionary = _static_inputs(spark, sf_dir)
    out = scratch_path(spark, "stream-lines")
    P.run_classification_stream(spark, feed, contents, model_row, dictionary, out,
                                scratch_path(spark, "stream-ckpt"),
                                scoring_partitions=spark.sparkContext.defaultParallelism)
    return out


@register("stream_photo_urls", "WITH " + POSTS_CTE.strip() + "\nSELECT id, url FROM urls",
          "S8,T1,T2,T3,F7,F8,F9,F10,P8,U2,T11")
def stream_photo_urls_df(spark, sf_dir):
    feed = _feed(spark, sf_dir)
    posts = spark.readStream.schema(P.POST_SCHEMA).option("maxFilesPerTrigger", 8).json(feed)
    urls = P.photo_urls(P.keyword_filter(posts)).select("id", "url")
    out, ckpt = scratch_path(spark, "stream-urls"), scratch_path(spark, "stream-urls-ckpt")
    (urls.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
     .trigger(availableNow=True).start(out).awaitTermination())
    return spark.read.parquet(out)


@register("stream_classification", STREAM_CTE + "\nSELECT url, label, pct FROM lines",
          "S7,T4,T5,T6,T7,F11,P9,M10,X13,K7,S9,T10")
def stream_classification_df(spark, sf_dir):
    out = _run_classification(spark, sf_dir)
    return P.parse_lines(spark.read.schema("value string").text(out))


@register("stream_top25", STREAM_CTE + f"""
SELECT label, n, upper(label) AS label_key FROM (
  SELECT label, count(*) AS n FROM lines GROUP BY label ORDER BY n DESC, label LIMIT {C.RANKING_SIZE})""",
          "T8,A13,O9,X17")
def stream_top25_df(spark, sf_dir):
    lines_dir = _run_classification(spark, sf_dir)
    table = scratch_path(spark, "ranking")
    P.run_ranking_stream(spark, lines_dir, table, scratch_path(spark, "ranking-ckpt"))
    return P.top_ranking(P.read_ranking(spark, table)).select("label", "n", "label_key")


RECENT_SQL = f"""
SELECT label, url, first_id FROM (
  SELECT label, url, first_id,
         row_number() OVER (PARTITION BY label ORDER BY first_id DESC, url DESC) AS rn
  FROM (SELECT label, url, min(id) AS first_id FROM srows GROUP BY label, url))
WHERE rn <= {C.RECENT_PER_LABEL}"""


@register("label_recent40", STREAM_CTE + RECENT_SQL, "W3,A14 (batch)")
def label_recent40_df(spark, sf_dir):
    contents, model_row, dictionary = _static_inputs(spark, sf_dir)
    return R.latest(R.first_posts(P.classification_pipeline(_posts(spark, sf_dir), contents, model_row, dictionary)))


def _run_recent(spark, sf_dir) -> str:
    """The post feed in two deliveries, the later posts first; the stream stops
    after each and starts again on its checkpoint."""
    feed, table, checkpoint = (scratch_path(spark, n) for n in ("recent-posts", "recent", "recent-ckpt"))
    contents, model_row, dictionary = _static_inputs(spark, sf_dir)
    posts = _posts(spark, sf_dir)
    for delivery in (1, 0):
        posts.where(F.pmod("id", F.lit(2)) == delivery).write.mode("append").json(feed)
        R.run_recent_stream(spark, feed, contents, model_row, dictionary, table, checkpoint, files_per_trigger=64)
    return table


@register("label_recent40_stream", STREAM_CTE + RECENT_SQL, "T9,T10,W3,A14")
def label_recent40_stream_df(spark, sf_dir):
    return R.read_recent(spark, _run_recent(spark, sf_dir))


@register("label_latest_images", STREAM_CTE + f""",
top AS (SELECT label FROM lines GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
SELECT url, first_id FROM ({RECENT_SQL}) WHERE label = (SELECT label FROM top)""",
          "F13,T9 (one label, picked from the live ranking)")
def label_latest_images_df(spark, sf_dir):
    lines_dir, ranking = _run_classification(spark, sf_dir), scratch_path(spark, "ranking")
    P.run_ranking_stream(spark, lines_dir, ranking, scratch_path(spark, "ranking-ckpt"))
    picked = P.read_ranking(spark, ranking).orderBy(F.desc("n"), "label").first()
    ring = _run_recent(spark, sf_dir)
    return R.read_recent(spark, ring, picked["label"] if picked else "").select("url", "first_id")


# Deliveries of the deduplication feed: all posts, with the odd ones twice; a
# post of another year, which moves the watermark; then late posts of the first
# year (dropped) and posts of the other one, whose URLs count again.
DEDUP_DELAY = "400 days"
LATER = "1500 days"
DEDUP_SQL = "WITH " + POSTS_CTE.strip() + f""",
later AS (SELECT DISTINCT url FROM urls WHERE id % 2 = 0)
SELECT url, CAST(0 AS BIGINT) AS wave FROM (SELECT DISTINCT url FROM urls)
UNION ALL SELECT '{P.IMAGE_HOST}tick.jpg', 1 FROM (SELECT count(*) AS n FROM urls) WHERE n > 0
UNION ALL SELECT url, CAST(1 AS BIGINT) FROM later"""


@register("distinct_photo_urls", DEDUP_SQL, "T11 (deduplication within a watermark)")
def distinct_photo_urls_df(spark, sf_dir):
    feed, out, checkpoint = (scratch_path(spark, n) for n in ("dedup-posts", "dedup-urls", "dedup-ckpt"))
    posts = _posts(spark, sf_dir)
    later = posts.withColumn("ts", F.col("ts") + F.expr(f"interval {LATER}"))
    photo = F.array(F.struct(F.lit("photo").alias("type"), F.lit(P.IMAGE_HOST + "tick.jpg").alias("media_url_https")))
    tick = later.orderBy("id").limit(1).select(
        F.lit(-1).cast("bigint").alias("id"), "ts", F.lit("photo").alias("text"),
        F.struct(F.lit(None).cast(P.MEDIA).alias("media")).alias("entities"), F.struct(photo.alias("media")).alias("extended_entities"))
    first = posts.agg(F.min("ts")).first()[0]
    odd, even = (posts.where(F.pmod("id", F.lit(2)) == k) for k in (1, 0))
    deliveries = [posts.unionByName(odd), tick, even.unionByName(odd).unionByName(later.where(F.pmod("id", F.lit(2)) == 0))]
    for rows in deliveries:
        rows.write.mode("append").json(feed)
        R.run_distinct_url_stream(spark, feed, out, checkpoint, DEDUP_DELAY)
    wave = (F.col("ts") >= F.lit(first) + F.expr(f"interval {DEDUP_DELAY}")).cast("bigint")
    return spark.read.schema("id bigint, ts timestamp, url string").parquet(out).select("url", wave.alias("wave"))


@register("label_drilldown", STREAM_CTE + """
SELECT label, count(DISTINCT url) AS n_images, count(*) AS n_lines FROM srows GROUP BY label""",
          "A14,A13")
def label_drilldown_df(spark, sf_dir):
    feed_posts = _posts(spark, sf_dir)
    contents, model_row, dictionary = _static_inputs(spark, sf_dir)
    rows = P.classification_pipeline(feed_posts, contents, model_row, dictionary)
    return rows.groupBy("label").agg(F.count_distinct("url").alias("n_images"), F.count(F.lit(1)).alias("n_lines"))
