"""Statistics fixture, forest vs MLlib, listing, posts and stream = batch."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tagloom.functions import constants as C
from tagloom.operators import features as FE
from tagloom.operators import trees as TR
from tagloom.streaming import posts as P

from .conftest import SF_SMOKE


def test_statistics_fixture(spark):
    """FIXTURES.md section 5: inner join, counts only."""
    truth = spark.createDataFrame([(1, "cat"), (2, "cat"), (3, "cat"), (4, "dog"), (5, "sun")], "id long, label string")
    pred = spark.createDataFrame([(2, "cat"), (3, "cat"), (9, "cat"), (7, "dog"), (1, "sky")], "id long, label string")
    rows = {r.label: (r.num_images, r.num_predicciones, r.aciertos)
            for r in TR.prediction_statistics(pred, truth).collect()}
    assert rows == {"cat": (3, 3, 2), "dog": (1, 1, 0)}


def test_forest_matches_mllib_on_binary_features(spark):
    """Level-wise forest == MLlib DecisionTreeClassifier predictions (binary
    features, depth 3) on a deterministic fixture."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    n, d = 240, 6
    rows, feats, truth = [], [], []
    for i in range(n):
        bits = [(i * (k + 3) + k * k) % (k + 2) == 0 for k in range(d)]
        y = int((bits[0] and not bits[2]) or (bits[1] and bits[3]))
        rows.append((i, float(y), Vectors.dense([1.0 if b else 0.0 for b in bits])))
        feats += [(i, k, 1.0) for k in range(d) if bits[k]]
        truth += [(i, "t")] * y
    data = spark.createDataFrame(rows, ["id", "y", "features"]).withColumn("train", FE.is_train(F.col("id")))
    model = DecisionTreeClassifier(labelCol="y", maxDepth=3, impurity="gini").fit(data.where("train"))
    mllib = {r.id for r in model.transform(data.where("not train")).where("prediction = 1").collect()}
    f_df = spark.createDataFrame(feats, "id long, f long, v double")
    images = TR.image_rows(data.select("id"), TR.fixed_bins(f_df, TR.BINARY_THRESHOLDS),
                           spark.createDataFrame(truth, "id long, label string"), ["t"])
    ours = {r.id for r in TR.predicted_pairs(TR.train(images, ["t"], 3), images, 3).collect()}
    assert ours == mllib and ours


def test_listing_parses_link_text(spark):
    from tagloom.plans import q_scoring as QS  # noqa: F401
    html = "<ul><li><a>skip</a></li><li><a href='/x'>im1.jpg</a></li><li>plain</li><li><a>im2.jpg</a></li></ul>"
    df = spark.createDataFrame([(7, "http://h", html)], "page_id long, url string, html string")
    pieces = df.select("page_id", F.posexplode(F.split("html", "<li>")).alias("pos", "piece")).where("pos >= 2")
    names = [r.n for r in pieces.select(F.get(F.split(F.get(F.split("piece", "<"), 1), ">"), 1).alias("n"))
             .orderBy("pos").collect()]
    # "plain</li>": second piece after "<" is "/li>", its second piece after ">" is "".
    assert names == ["im1.jpg", "", "im2.jpg"]


POSTS = [
    {"id": 1, "text": "a photo", "entities": {"media": [{"type": "photo", "media_url_https": "https://x/tweet_video_thumb/a.jpg"}]},
     "extended_entities": {"media": [{"type": "photo", "media_url_https": "https://x/b.jpg"},
                                     {"type": "video", "media_url_https": "https://x/v.jpg"}]}},
    {"id": 2, "text": "none", "entities": {"media": None}},
]


def test_post_fixture_urls(spark):
    d = tempfile.mkdtemp(prefix="posts-")
    with open(os.path.join(d, "p.json"), "w") as fh:
        fh.write("\n".join(json.dumps(p) for p in POSTS))
    posts = spark.read.schema(P.POST_SCHEMA).json(d)
    urls = sorted(r.url for r in P.photo_urls(P.keyword_filter(posts, None)).collect())
    assert urls == ["https://x/b.jpg", "https://x/tweet_video_thumb/a.jpg"]
    assert P.keyword_filter(posts, "photo").count() == 1


def test_stream_equals_batch(spark):
    from tagloom.operators import scoring as SC
    from tagloom.plans import q_scoring as QS
    from tagloom.session import scratch_path
    from tagloom.sources import tables

    events = tables.table(spark, SF_SMOKE, "events")
    feed = scratch_path(spark, "test-feed")
    contents = tables.table(spark, SF_SMOKE, "embeddings").select("vec_id", "embedding")
    P.posts_from_events(events, contents).write.json(feed)
    model_row = SC.model_row(QS.model(spark, SF_SMOKE))
    dictionary = QS.dictionary(spark, SF_SMOKE)
    out = scratch_path(spark, "test-lines")
    P.run_classification_stream(spark, feed, contents, model_row, dictionary, out, scratch_path(spark, "test-ck"))
    streamed = sorted(r.value for r in spark.read.text(out).collect())
    batch_posts = spark.read.schema(P.POST_SCHEMA).json(feed)
    rows = P.classification_pipeline(batch_posts, contents, model_row, dictionary)
    from tagloom.functions import text as X
    batch = sorted(r.v for r in rows.select(X.classification_line(F.col("url"), F.col("label"), F.col("prob")).alias("v")).collect())
    assert streamed == batch and len(batch) > 0


def test_posts_name_every_image(spark):
    events = spark.range(5000).select(F.col("id").alias("event_id"), (F.col("id") * 3).alias("user_id"), F.lit("view").alias("event_type"),
                                      F.lit(99.0).alias("value"), F.lit("p").alias("props"), F.current_timestamp().alias("ts"))
    contents = spark.range(2000).select(F.col("id").alias("vec_id"))
    keys = {r.k for r in P.photo_urls(P.posts_from_events(events, contents)).select(P.url_key(F.col("url")).alias("k")).collect()}
    assert set(range(2000)) <= keys and max(keys) > 2000


def test_ranking_versions(spark):
    from tagloom.session import scratch_path
    lines, table = scratch_path(spark, "rank-lines"), scratch_path(spark, "rank-table")
    ckpt = scratch_path(spark, "rank-ckpt")
    for k in range(2):
        spark.createDataFrame([("u|a|1.00",), (f"v|{'ab'[k]}|2.00",)], "value string").write.mode("append").text(lines)
        P.run_ranking_stream(spark, lines, table, ckpt)
    assert {r.label: r.n for r in P.read_ranking(spark, table).collect()} == {"a": 3, "b": 1}


def test_numbered_counts_over_the_whole_listing(spark):
    from tagloom.operators import scoring as SC
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("a"), F.col("id").alias("b"))
    rows = SC.numbered(df, ["a", "b"], "n").collect()
    assert [r.n for r in sorted(rows, key=lambda r: (r.a, r.b))] == list(range(5000))


def test_sentinel_for_missing_content(spark):
    from tagloom.operators import scoring as SC
    from tagloom.plans import q_scoring as QS
    index = spark.createDataFrame([(0,), (10 ** 9,)], "id long")
    contents = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    out = SC.classify_images(index, contents, QS.model(spark, SF_SMOKE), QS.dictionary(spark, SF_SMOKE), "id")
    rows = out.collect()
    missing = [r for r in rows if r.id == 10 ** 9]
    assert [(r.label, r.score) for r in missing] == [(C.NONE_LABEL, C.NONE_SCORE)]
    found = sorted((r.score for r in rows if r.id == 0), reverse=True)
    assert len(found) == C.MAX_SCORE_LABELS and sum(found) <= 1.0 + 1e-9


def test_tag_files_reader(spark):
    from tagloom.sources import tables
    d = tempfile.mkdtemp(prefix="tags-")
    for n, body in [(12, "Canon EOS 40D\nsunset"), (7, "beach")]:
        with open(os.path.join(d, f"tags{n}.txt"), "w") as fh:
            fh.write(body)
    rows = sorted((r.image, r.label) for r in tables.read_tag_files(spark, d).collect())
    assert rows == [("12", "Canon EOS 40D"), ("12", "sunset"), ("7", "beach")]


def test_entry_contract(spark):
    import importlib.util
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(here, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0 and df.columns == ["label_normalized", "tag_count"]
    assert set(mod.oracle_sql()) <= set(mod.queries())


def test_tag_analysis_job_writes_all_outputs(spark):
    from tagloom.plans import jobs
    from tagloom.plans import q_scoring as QS
    from tagloom.session import scratch_path
    from tagloom.sources import standins, tables

    lines = standins.tag_lines(spark, SF_SMOKE)
    docs = tables.table(spark, SF_SMOKE, "documents")
    lang_lines = docs.select("lang", F.explode(F.split("text", "\\n")).alias("label"))
    out = scratch_path(spark, "job")
    paths = jobs.tag_analysis_job(spark, lines, QS.classification(spark, SF_SMOKE), out, lang_lines)
    assert len(paths) == 10
    top = [r.value for r in spark.read.text(paths["common_tags"]).collect()]
    expected = [r.label_normalized for r in QS.T.top_tags(QS.T.tag_counts(QS.T.normalized_tags(lines))).collect()]
    assert sorted(top) == sorted(expected) and len(top) == C.TOP_TAGS
    counts = tables.read_delimited(spark, paths["tag_analysis"], tables.LABEL_COUNT_SCHEMA, "~")
    assert counts.count() == spark.read.text(paths["all_tags"]).count()
    assert spark.read.text(paths["languages"]).count() >= 1


def test_inference_job(spark):
    from tagloom.plans import jobs
    from tagloom.plans import q_inference as QI
    from tagloom.session import scratch_path
    from tagloom.sources import tables

    feats = QI.tag_pairs(spark, SF_SMOKE)
    targets = QI.model_pairs(spark, SF_SMOKE)
    labels = targets.where(F.col("label") != C.NONE_LABEL).select("label").distinct()
    out = scratch_path(spark, "inference")
    pred_path, stats_path = jobs.inference_job(spark, feats, targets, labels, out, True, depth=2)
    stats = tables.read_json_lines(spark, stats_path, tables.STATS_SCHEMA).collect()
    assert all(r.aciertos <= min(r.num_images, r.num_predicciones) for r in stats)
    assert tables.read_pairs(spark, pred_path).count() >= 0
