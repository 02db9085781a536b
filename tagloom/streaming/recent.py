"""Live drill-down: the latest image URLs of every label, and URL deduplication.

``run_recent_stream`` keeps two things per trigger:

* the first post of every (label, url), as state of a streaming aggregate (a
  combined minimum per key, spread over the state store's partitions, so a label
  that holds most posts is no hot group);
* the ring: the ``n`` latest URLs of every label, a table of labels times ``n``
  rows, merged in ``foreachBatch`` from the last ring and the rows that the
  trigger changed, and published as a new version.

A URL's place is that of its first post.  Posts may come in any order: where a
first post turns out to be earlier than the ring had it, a URL that left the ring
may have to come back, and the rings of just those labels are made from the log
of first posts, to which every trigger appends what it changed.  A trigger that
is run again after a failure writes the same log part and the same version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from . import posts as P
from . import versions as V

RING = "label string, url string, first_id bigint"


def first_posts(rows: DataFrame) -> DataFrame:
    """(label, url, first_id) of classified rows (batch or stream)."""
    return rows.groupBy("label", "url").agg(F.min("id").alias("first_id"))


def latest(firsts: DataFrame, n: int = C.RECENT_PER_LABEL) -> DataFrame:
    """The ``n`` latest URLs of each label; ties by url.  The rank filter is
    applied per task before the shuffle, so a hot label ships few rows."""
    order = Window.partitionBy("label").orderBy(F.desc("first_id"), F.desc("url"))
    return firsts.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")


def _merge(spark: SparkSession, table_dir: str, n: int, keep: int):
    ring_dir, log_dir = f"{table_dir.rstrip('/')}/ring", f"{table_dir.rstrip('/')}/log"

    def merge(batch: DataFrame, batch_id: int) -> None:
        # The log part is written first; from here on the batch is read from it.
        batch.select("label", "url", "first_id").write.mode("overwrite").parquet(V.version_path(log_dir, batch_id))
        changed = spark.read.schema(RING).parquet(V.version_path(log_dir, batch_id))
        ring = V.read_version(spark, ring_dir, RING, before=batch_id)
        earlier = changed.select("label", "url", F.col("first_id").alias("new_id"))
        moved = ring.join(earlier, ["label", "url"]).where("new_id < first_id").select("label").distinct()
        rows = ring.unionByName(changed)
        if not moved.isEmpty():
            log = spark.read.schema(RING + ", batch_id bigint").parquet(log_dir).where(F.col("batch_id") <= batch_id)
            rows = rows.unionByName(log.select("label", "url", "first_id").join(F.broadcast(moved), "label", "left_semi"))
        merged = latest(rows.groupBy("label", "url").agg(F.min("first_id").alias("first_id")), n)
        V.publish(merged, ring_dir, batch_id, keep)
    return merge


def run_recent_stream(spark: SparkSession, posts_dir: str, contents: DataFrame, model_row: DataFrame, dictionary: DataFrame,
                      table_dir: str, checkpoint: str, keyword: str | None = "photo", files_per_trigger: int = 8,
                      n: int = C.RECENT_PER_LABEL, keep: int = V.KEEP, trigger: dict | None = None):
    """Posts folder -> the ring of every label below ``table_dir``, a new version
    per trigger; started again on the same checkpoint, it goes on where it was."""
    feed = spark.readStream.schema(P.POST_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(posts_dir)
    firsts = first_posts(P.classification_pipeline(feed, contents, model_row, dictionary, keyword))
    query = (firsts.writeStream.outputMode("update").foreachBatch(_merge(spark, table_dir, n, keep))
             .option("checkpointLocation", checkpoint).trigger(**(trigger or P.AVAILABLE_NOW)).start())
    return P._awaited(query, trigger)


def read_recent(spark: SparkSession, table_dir: str, label: str | None = None) -> DataFrame:
    """(label, url, first_id) of the newest ring; of one label, if given (the
    filter reaches the scan)."""
    ring = V.read_version(spark, f"{table_dir.rstrip('/')}/ring", RING)
    return ring if label is None else ring.where(F.col("label") == label)


def distinct_urls(posts: DataFrame, delay: str, keyword: str | None = "photo") -> DataFrame:
    """(id, ts, url) of a stream of posts, each URL once within ``delay`` of its
    first post; posts later than ``delay`` behind the newest one are dropped.

    The state holds the URLs of one delay, whatever the stream's age."""
    urls = P.photo_urls(P.keyword_filter(posts.withWatermark("ts", delay), keyword))
    return urls.dropDuplicatesWithinWatermark(["url"])


def run_distinct_url_stream(spark: SparkSession, posts_dir: str, out_dir: str, checkpoint: str, delay: str,
                            keyword: str | None = "photo", files_per_trigger: int = 1000, trigger: dict | None = None):
    """Posts folder -> Parquet rows of ``distinct_urls``, appended."""
    feed = spark.readStream.schema(P.POST_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(posts_dir)
    query = (distinct_urls(feed, delay, keyword).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(**(trigger or P.AVAILABLE_NOW)).start(out_dir))
    return P._awaited(query, trigger)
