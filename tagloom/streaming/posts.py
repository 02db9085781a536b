"""Social-post photo classification as Structured Streaming queries.

post stream (JSON files, schema fixed)
  -> keyword predicate on the text (word match) and an optional user predicate
  -> photo URLs: plain media of type photo whose URL contains
     'tweet_video_thumb', plus every extended media of type photo
  -> stream-static inner join with stored image content (missing -> dropped)
  -> top-3 labels of the content vector (same scorer as the batch job)
  -> 'url|label|pct' lines, appended to a checkpointed text sink

A second query keeps the live label ranking: complete-mode counts of the
appended lines, each trigger overwriting a small table (bounded by the number
of labels).  Both run with ``availableNow`` in tests and any trigger on a
cluster; the checkpoint folder comes from the session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as C
from ..functions import text as X
from ..operators import scoring as SC
from . import versions as V

MEDIA = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("media_url_https", T.StringType()),
]))
POST_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("text", T.StringType()),
    T.StructField("entities", T.StructType([T.StructField("media", MEDIA)])),
    T.StructField("extended_entities", T.StructType([T.StructField("media", MEDIA)])),
])

IMAGE_HOST = "https://pbs.example.net/media/"


def posts_from_events(events: DataFrame, contents: DataFrame) -> DataFrame:
    """Stand-in posts: one per event; media URLs name images 'im<k>' over the
    whole id range of ``contents`` (vec_id), and in extended media an eighth
    beyond it, which have no content."""
    n_images = (contents.agg(F.max("vec_id")).first()[0] or 0) + 1
    k1 = F.pmod(F.col("event_id"), F.lit(n_images))
    k2 = F.pmod(F.col("event_id") * 7 + 3, F.lit(n_images + n_images // 8 + 1))
    thumb = F.when(F.pmod(F.col("user_id"), F.lit(3)) == 0, F.lit("tweet_video_thumb/")).otherwise(F.lit(""))
    plain = F.array(F.struct(
        F.when(F.col("event_type") == "error", "video").otherwise("photo").alias("type"),
        F.concat(F.lit(IMAGE_HOST), thumb, F.lit("im"), k1.cast("string"), F.lit(".jpg")).alias("media_url_https")))
    extended = F.when(F.col("event_type").isin("view", "purchase"), F.array(
        F.struct(F.lit("photo").alias("type"),
                 F.concat(F.lit(IMAGE_HOST), F.lit("ext/im"), k2.cast("string"), F.lit(".jpg")).alias("media_url_https")),
        F.struct(F.lit("video").alias("type"),
                 F.concat(F.lit(IMAGE_HOST), F.lit("v"), k2.cast("string"), F.lit(".jpg")).alias("media_url_https"))))
    text = F.concat_ws(" ", F.col("event_type"),
                       F.when(F.col("value") > 50, F.lit("photo")).otherwise(F.lit("post")),
                       F.col("props"))
    return events.select(F.col("event_id").alias("id"), "ts", text.alias("text"),
                         F.struct(plain.alias("media")).alias("entities"),
                         F.struct(extended.alias("media")).alias("extended_entities"))


def keyword_filter(posts: DataFrame, keyword: str | None = "photo",
                   predicate: Column | None = None) -> DataFrame:
    """Keep posts whose text contains ``keyword`` as a word (no keyword =
    unfiltered sample); ``predicate`` is an extra user filter."""
    out = posts
    if keyword:
        out = out.where(F.lower(F.col("text")).rlike("\\b" + keyword.lower() + "\\b"))
    if predicate is not None:
        out = out.where(predicate)
    return out


def photo_urls(posts: DataFrame) -> DataFrame:
    """0..n URL rows per post (duplicates kept)."""
    plain = F.transform(
        F.filter(F.coalesce(F.col("entities.media"), F.array().cast(MEDIA)),
                 lambda m: (m["type"] == "photo") & m["media_url_https"].contains("tweet_video_thumb")),
        lambda m: m["media_url_https"])
    extended = F.transform(
        F.filter(F.coalesce(F.col("extended_entities.media"), F.array().cast(MEDIA)),
                 lambda m: m["type"] == "photo"),
        lambda m: m["media_url_https"])
    return posts.select("id", "ts", F.explode(F.concat(plain, extended)).alias("url"))


def url_key(url: Column) -> Column:
    return X.image_number(X.url_base_name(url))


def with_content(urls: DataFrame, contents: DataFrame) -> DataFrame:
    """Stream-static inner join on the image key: URLs without content drop."""
    return urls.join(contents, url_key(F.col("url")) == contents["vec_id"]).drop("vec_id")


def classify_rows(df: DataFrame, model_row: DataFrame, dictionary: DataFrame,
                  k: int = C.STREAM_LABELS) -> DataFrame:
    """(id, ts, url, rank, label, prob) top-k of every enriched URL row."""
    m = F.broadcast(model_row)
    scored = (df.withColumn("_k", F.lit(0)).join(m, "_k")
              .where(SC.valid_vector(F.col("embedding"), F.col("dim")))
              .select("id", "ts", "url", F.posexplode(SC.top_k(SC.probabilities(F.col("embedding"), F.col("classes")), k))
                      .alias("pos", "t"))
              .select("id", "ts", "url", (F.col("pos") + 1).alias("rank"), F.col("t.node").alias("node"),
                      F.col("t.prob").alias("prob")))
    return SC.name_nodes(scored, dictionary)


def classification_pipeline(posts: DataFrame, contents: DataFrame, model_row: DataFrame,
                            dictionary: DataFrame, keyword: str | None = "photo") -> DataFrame:
    """Same plan for a stream or a batch of posts."""
    urls = photo_urls(keyword_filter(posts, keyword))
    return classify_rows(with_content(urls, contents), model_row, dictionary)


def run_classification_stream(spark: SparkSession, posts_dir: str, contents: DataFrame, model_row: DataFrame,
                              dictionary: DataFrame, out_dir: str, checkpoint: str,
                              keyword: str | None = "photo", files_per_trigger: int = 8,
                              scoring_partitions: int | None = None, trigger: dict | None = None):
    """Posts folder -> 'url|label|pct' text lines appended to ``out_dir``.

    ``scoring_partitions`` spreads the URL rows over that many tasks before
    the content join and scoring (the costly stage), like the reference's
    per-stage parallelism; by default the source partitioning is kept.

    ``trigger``: arguments of ``DataStreamWriter.trigger``.  By default all that
    is there is processed and the query ends; with another one, such as
    ``{"processingTime": "10 seconds"}``, the running query is returned."""
    posts = spark.readStream.schema(POST_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(posts_dir)
    if scoring_partitions:
        urls = photo_urls(keyword_filter(posts, keyword)).repartition(scoring_partitions)
        rows = classify_rows(with_content(urls, contents), model_row, dictionary)
    else:
        rows = classification_pipeline(posts, contents, model_row, dictionary, keyword)
    lines = rows.select(X.classification_line(F.col("url"), F.col("label"), F.col("prob")).alias("value"))
    query = (lines.writeStream.format("text").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start(out_dir))
    return _awaited(query, trigger)


AVAILABLE_NOW = {"availableNow": True}


def _awaited(query, trigger: dict | None):
    if not trigger or "processingTime" not in trigger and "continuous" not in trigger:
        query.awaitTermination()
    return query


def parse_lines(lines: DataFrame) -> DataFrame:
    parts = F.split(F.col("value"), "\\|")
    return lines.select(F.get(parts, 0).alias("url"), F.get(parts, 1).alias("label"),
                        F.get(parts, 2).try_cast("double").alias("pct"))


def run_ranking_stream(spark: SparkSession, lines_dir: str, table_dir: str, checkpoint: str,
                       trigger: dict | None = None, keep: int = V.KEEP):
    """Live label counts over the appended lines (complete mode); each trigger
    writes the current counts as a new version in ``table_dir``, which
    ``read_ranking`` sees once it is whole, and all but the last ``keep`` go.
    ``trigger`` as above."""
    lines = spark.readStream.schema("value string").text(lines_dir)
    counts = parse_lines(lines).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    query = (counts.writeStream.outputMode("complete").foreachBatch(lambda batch, n: V.publish(batch, table_dir, n, keep))
             .option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start())
    return _awaited(query, trigger)


def read_ranking(spark: SparkSession, table_dir: str) -> DataFrame:
    """The latest published counts (label, n)."""
    return V.read_version(spark, table_dir, "label string, n bigint")


def top_ranking(counts: DataFrame, n: int = C.RANKING_SIZE) -> DataFrame:
    """First ``n`` labels by count (ties by label), listed by upper-case label."""
    return (counts.orderBy(F.desc("n"), F.asc("label")).limit(n)
            .withColumn("label_key", F.upper("label")).orderBy("label_key", "label"))
