"""Streaming state: restarts, latest images, retention, deduplication."""

import time

from pyspark.sql import functions as F

from tagloom.operators import scoring as SC
from tagloom.plans import q_scoring as QS
from tagloom.plans import q_streaming as QT
from tagloom.session import scratch_path
from tagloom.sources import tables
from tagloom.streaming import posts as P
from tagloom.streaming import recent as R
from tagloom.streaming import versions as V

from .conftest import SF_SMOKE


def _inputs(spark):
    contents = tables.table(spark, SF_SMOKE, "embeddings").select("vec_id", "embedding")
    return contents, SC.model_row(QS.model(spark, SF_SMOKE)), QS.dictionary(spark, SF_SMOKE)


def _key(rows):
    return sorted((r.label, r.url, r.first_id) for r in rows)


def test_latest_images_over_restarts_in_any_order(spark):
    """Three deliveries, the newest posts first, small rings: after each, the
    stored ring is what a batch over all posts so far gives."""
    contents, model, names = _inputs(spark)
    feed, table, ckpt = (scratch_path(spark, n) for n in ("t-posts", "t-ring", "t-ckpt"))
    posts = QT._posts(spark, SF_SMOKE)
    for k in (2, 0, 1):
        posts.where(F.pmod("id", F.lit(3)) == k).write.mode("append").json(feed)
        R.run_recent_stream(spark, feed, contents, model, names, table, ckpt, files_per_trigger=2, n=5, keep=2)
        so_far = spark.read.schema(P.POST_SCHEMA).json(feed)
        want = R.latest(R.first_posts(P.classification_pipeline(so_far, contents, model, names)), 5)
        got = R.read_recent(spark, table).collect()
        assert _key(got) == _key(want.collect()) and got
    label = got[0].label
    assert _key(R.read_recent(spark, table, label).collect()) == _key(r for r in got if r.label == label)
    assert len(V.versions(spark, table + "/ring")) == 2


def test_a_trigger_that_runs_again_gives_the_same_ring(spark):
    table = scratch_path(spark, "again")
    merge = R._merge(spark, table, 2, 3)
    def rows(*r):
        return spark.createDataFrame(list(r), R.RING)
    merge(rows(("a", "u1", 1), ("a", "u2", 2), ("a", "u3", 3)), 0)
    for _ in range(2):
        merge(rows(("a", "u3", 0), ("b", "u9", 9)), 1)
        assert _key(R.read_recent(spark, table).collect()) == [("a", "u1", 1), ("a", "u2", 2), ("b", "u9", 9)]


def test_versions_are_kept_whole_and_few(spark):
    table = scratch_path(spark, "versions")
    assert V.read_version(spark, table, "n bigint").collect() == []
    for k in range(6):
        V.publish(spark.range(k + 1).withColumnRenamed("id", "n"), table, k, keep=3)
    assert V.versions(spark, table) == [3, 4, 5]
    assert V.read_version(spark, table, "n bigint").count() == 6
    assert V.read_version(spark, table, "n bigint", before=5).count() == 5
    # A version without its marker is not seen.
    spark.range(99).withColumnRenamed("id", "n").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(V.version_path(table, 9))
    assert V.read_version(spark, table, "n bigint").count() == 6


def test_timed_ranking_stops_and_goes_on(spark):
    """A processing-time query is stopped and started again: no line counts
    twice, old versions are gone."""
    lines, table, ckpt = (scratch_path(spark, n) for n in ("timed-lines", "timed-table", "timed-ckpt"))
    total = 0
    for k in range(3):
        spark.createDataFrame([(f"u{k}|a|1.00",), (f"v{k}|{'ab'[k % 2]}|2.00",)], "value string").write.mode("append").text(lines)
        total += 2
        query = P.run_ranking_stream(spark, lines, table, ckpt, {"processingTime": "200 milliseconds"}, keep=2)
        end = time.time() + 60
        while time.time() < end and sum(r.n for r in P.read_ranking(spark, table).collect()) < total:
            assert query.exception() is None
            time.sleep(0.2)
        query.stop()
        query.awaitTermination()
        assert sum(r.n for r in P.read_ranking(spark, table).collect()) == total
    assert {r.label: r.n for r in P.read_ranking(spark, table).collect()} == {"a": 5, "b": 1}
    assert len(V.versions(spark, table)) <= 2


def test_repeated_and_late_urls(spark):
    def post(i, day, url):
        media = [{"type": "photo", "media_url_https": url}]
        return (i, f"2024-03-{day:02d} 00:00:00", "photo", None, {"media": media})
    schema = ("id long, day string, text string, entities struct<media:array<struct<type:string,media_url_https:string>>>, "
              "extended_entities struct<media:array<struct<type:string,media_url_https:string>>>")
    feed, out, ckpt = (scratch_path(spark, n) for n in ("d-posts", "d-urls", "d-ckpt"))
    deliveries = [
        [post(1, 1, "a"), post(2, 1, "a"), post(3, 1, "b")],
        [post(4, 2, "a"), post(5, 20, "c")],   # a is repeated within the delay
        [post(6, 1, "d"), post(7, 20, "b")],   # d is late; b was forgotten
    ]
    for rows in deliveries:
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("day")).drop("day")
        df.write.mode("append").json(feed)
        R.run_distinct_url_stream(spark, feed, out, ckpt, "5 days")
    got = spark.read.schema("id long, ts timestamp, url string").parquet(out).collect()
    assert sorted((r.url, r.ts.day) for r in got) == [("a", 1), ("b", 1), ("b", 20), ("c", 20)]
