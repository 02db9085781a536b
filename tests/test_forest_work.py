"""Work of the forests and of the MLlib fits: counts in one table, common images
found once, fits side by side."""

import collections
import random
import threading
import time
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.operators import tags as T
from tagloom.operators import trees as TR
from tagloom.plans import q_inference as Q


@pytest.mark.parametrize("table", [0, TR._TABLE])
def test_split_counts_in_a_table_and_sorted(monkeypatch, table):
    monkeypatch.setattr(TR, "_TABLE", table)
    rng = random.Random(7)
    shape = (3, 8)
    forest = TR.Forest(["a", "b", "c"], 6, *(np.zeros(shape, np.int64) for _ in range(4)))
    forest.feature[:] = -1
    forest.feature[0, 1], forest.bin[0, 1] = 2, 2
    forest.feature[2, 1], forest.bin[2, 1] = 5, 1
    forest.n[:], forest.n1[:] = 9, 4
    forest.n1[0, 3] = 0
    images = [(sorted(rng.sample(range(6), rng.randint(0, 5))), sorted(rng.sample(range(3), rng.randint(0, 3)))) for _ in range(500)]
    rows = [(fs, [rng.randint(1, 4) for _ in fs], y) for fs, y in images]
    kind = pa.list_(pa.int32())
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i in range(3)], names=["fs", "bins", "positives"])
    nodes = [tuple(x) for x in forest.active(1).tolist()]
    want = collections.Counter()
    for fs, bins, y in rows:
        dense = dict(zip(fs, bins))
        for t in range(3):
            f = forest.feature[t, 1]
            node = 1 if f < 0 else 2 + (dense.get(f, 0) >= forest.bin[t, 1])
            if (t, node) in nodes:
                for f, b in dense.items():
                    want[nodes.index((t, node)) * 6 * 256 + f * 256 + b, 0] += 1
                    want[nodes.index((t, node)) * 6 * 256 + f * 256 + b, 1] += t in y
    got = collections.Counter()
    for out in TR._split_counts(types.SimpleNamespace(value=forest), 1, 6 * 256, 4)(iter([batch.slice(0, 200), batch.slice(200)])):
        for key, c, c1 in zip(*(x.to_pylist() for x in out.columns)):
            got[key, 0] += c
            got[key, 1] += c1
    assert want and +got == +want


def test_common_images_are_found_once(spark):
    for direction in (Q.direction_tags_to_labels, Q.direction_labels_to_tags):
        ids = direction(spark, "/root/testdata/sf0.001")[-1]
        assert "Join" not in ids._jdf.queryExecution().optimizedPlan().toString()


def test_mllib_fits_run_side_by_side_with_the_same_predictions(spark, monkeypatch):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors
    rows = [(i, Vectors.dense([float(i % 2), float(i % 3)])) for i in range(200)]
    vectors = spark.createDataFrame(rows, ["id", "features"])
    ids = spark.range(200)
    truth = ids.select("id", F.explode(F.array(F.lit("all"), F.when(F.col("id") % 2 == 1, "odd").otherwise("even"),
                                               F.when(F.col("id") % 3 == 2, "two"))).alias("label")).where("label is not null")
    fit, running, most = DecisionTreeClassifier.fit, [], []

    def watched(self, data):
        running.append(threading.get_ident())
        most.append(len(running))
        time.sleep(0.3)
        try:
            return fit(self, data)
        finally:
            running.remove(threading.get_ident())
    monkeypatch.setattr(DecisionTreeClassifier, "fit", watched)
    got = {(r["id"], r["label"]) for r in Q.mllib_fits(vectors, ids, truth, ["even", "odd", "two"], 3).collect()}
    test = {r["id"] for r in ids.where(~Q.FE.is_train(F.col("id"))).collect()}
    want = {(i, "odd" if i % 2 else "even") for i in test} | {(i, "two") for i in test if i % 3 == 2}
    assert got == want and 1 < max(most) <= Q.FITS_AT_ONCE


def test_image_tags_are_the_grouped_normalised_tags(spark):
    rows = [(1, "The red cars"), (1, "cars RED"), (2, "the"), (3, None), (None, "dogs"), (1, "The red cars"), (4, "geo:lat=1.5 Canon EOS 5D"), (5, "")]
    lines = spark.createDataFrame(rows, "image long, label string")
    want = T.normalized_tags(lines).groupBy("image").agg(F.array_sort(F.collect_set("label_normalized")).alias("labels"))
    assert sorted(map(repr, T.image_tags(lines).collect())) == sorted(map(repr, want.collect()))
    # One shuffle of lines and one of arrays: no (image, token) rows move.
    assert T.image_tags(lines)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_mllib_stores_no_row_per_token_and_shuffles_by_the_cores(spark, monkeypatch):
    from pyspark.ml.classification import DecisionTreeClassifier

    fit, tasks, kept = DecisionTreeClassifier.fit, [], []

    def watched(self, data):
        tasks.append(data.rdd.getNumPartitions())
        return fit(self, data)
    store = Q.materialize
    monkeypatch.setattr(DecisionTreeClassifier, "fit", watched)
    monkeypatch.setattr(Q, "materialize", lambda df, name: kept.append(name) or store(df, name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert Q.mllib_predictions(spark, "/root/testdata/sf0.001", 2).count() > 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert kept == ["model-pairs", "mllib-predictions"] and 0 < max(tasks) <= spark.sparkContext.defaultParallelism
