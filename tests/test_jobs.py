"""The batch programs from their command line, lots, clean-up, MLlib's mirrored direction."""

import pytest
from pyspark.sql import functions as F

from tagloom import __main__ as cli
from tagloom.functions import constants as C
from tagloom.operators import scoring as SC
from tagloom.plans import q_files as QF
from tagloom.plans import q_inference as QI
from tagloom.plans import q_scoring as QS
from tagloom.session import drop_scratch, scratch_path
from tagloom.sources import sinks, tables

from .conftest import SF_SMOKE


def test_running_totals_over_many_tasks(spark):
    df = spark.range(0, 3000, 1, 7).select((F.col("id") * 7919 % 3001).alias("a"), (F.col("id") % 5).alias("n"))
    total = 0
    for r in sorted(SC.running_total(df, ["a"], "n", "before").collect()):
        assert r.before == total
        total += r.n


def test_lots_take_the_first_items_of_the_listing(spark):
    pages = QS._pages(spark, SF_SMOKE)
    every = sorted((r.page_id, r.pos) for r in QS.listing_of(pages).collect())
    got = QS.lots(pages, 50, 7).collect()
    assert sorted((r.page_id, r.pos) for r in got) == every[:50]
    assert all(r.lot == every.index((r.page_id, r.pos)) // 7 for r in got)
    odd = spark.createDataFrame([(1, "u", None), (1, "u", "<li>a<li><b>x</b><li><b>y</b>"), (None, "u", ""), (1, "u", "<li>a<li><b>z</b>")],
                                "page_id long, url string, html string")
    assert sorted((r.page_id, r.name, r.lot) for r in QS.lots(odd, None, 2).collect()) in (
        [(1, "x", 0), (1, "y", 0), (1, "z", 1)], [(1, "x", 0), (1, "y", 1), (1, "z", 0)])


def test_score_program(spark, tmp_path):
    contents = QF.stored_vectors(spark, SF_SMOKE)
    names = "".join(f"<li><a href='/x'>im{i}.jpg</a></li>" for i in range(40, 0, -1))
    (tmp_path / "index").mkdir()
    (tmp_path / "index" / "list.html").write_text(f"<ul><li><a>parent</a></li>{names}<li><a>readme.txt</a></li></ul>")
    model, dictionary, out = (str(tmp_path / n) for n in ("model", "names", "out"))
    QS.model(spark, SF_SMOKE).write.parquet(model)
    QS.dictionary(spark, SF_SMOKE).write.parquet(dictionary)
    cli.main(["score", "--index", str(tmp_path / "index"), "--contents", contents, "--model", model, "--names", dictionary,
              "--out", out, "-n", "25", "-l", "4", "-m", "2"], spark)
    rows = tables.read_scores(spark, out).collect()
    by = {}
    for r in rows:
        by.setdefault(int(r.image[2:]), []).append(r.label)
    assert sorted(by) == list(range(1, 26))
    assert all(labels == [C.NONE_LABEL] if i % QF.BROKEN_EVERY == QF.BROKEN_EVERY - 1 else len(labels) == 2 for i, labels in by.items())
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["score", "--index", "a", "--contents", "b", "--model", "c", "--names", "d", "--out", "e", "-l", "0"])


def test_tags_and_infer_programs(spark, tmp_path):
    lines = spark.createDataFrame([(f"tags{i}.txt", t) for i in range(60) for t in ("sunset", "beach" if i % 2 else "city", f"word{i % 7}")], "n string, v string")
    scores = spark.createDataFrame([(f"im{i}", "sea" if i % 2 else "tower", 0.9) for i in range(60)] + [("im99", C.NONE_LABEL, 1.0)], tables.SCORE_SCHEMA)
    tags, score_dir, out = (str(tmp_path / n) for n in ("tags", "scores", "out"))
    sinks.write_named_texts(lines, tags, "n", "v")
    sinks.write_json(scores, score_dir)
    cli.main(["tags", "--lines", tags, "--scores", score_dir, "--out", out, "--files", "2"], spark)
    pairs = tables.read_pairs(spark, out + "/user_tags/labels-images")
    assert pairs.count() == 180 and [r.value for r in spark.read.text(out + "/model_labels/none").collect()] == ["im99"]
    truth = str(tmp_path / "truth")
    sinks.write_json(scores.select(F.expr("cast(substr(image, 3) as bigint)").alias("id"), "label"), truth)
    cli.main(["infer", "--features", out + "/user_tags/labels-images", "--truth", truth, "--labels", out + "/model_labels/comunes",
              "--out", str(tmp_path / "predicted"), "--depth", "2"], spark)
    got = {(r.id, r.label) for r in tables.read_pairs(spark, str(tmp_path / "predicted") + "/predicciones").collect()}
    assert got and all(label == ("sea" if i % 2 else "tower") for i, label in got)
    cli.main(["infer", "--features", score_dir, "--scores", "--truth", out + "/user_tags/labels-images", "--labels", out + "/user_tags/comunes",
              "--out", str(tmp_path / "mirrored"), "--depth", "1"], spark)
    got = {(r.id, r.label) for r in tables.read_pairs(spark, str(tmp_path / "mirrored") + "/predicciones").collect()}
    assert {(i, "beach") for i, label in got if label == "beach"} and all(i % 2 for i, label in got if label == "beach")


def test_scratch_folders_can_be_dropped(spark):
    path = scratch_path(spark, "to-drop")
    spark.range(3).write.parquet(path)
    model = QS.model(spark, SF_SMOKE).count()
    assert drop_scratch(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
    assert drop_scratch(spark) == 0 and QS.model(spark, SF_SMOKE).count() == model


def test_mirrored_mllib_direction_against_the_own_forest(spark):
    """Both see the same sparse score vectors; bins differ where MLlib samples and
    takes midpoints, so predictions may differ: the share that does is bounded."""
    theirs, ours = QI.mllib_tag_predictions(spark, SF_SMOKE, 3, 4)
    a, b = ({(r.id, r.label) for r in df.collect()} for df in (theirs, ours))
    n_test = 4 * max(1, QI.direction_labels_to_tags(spark, SF_SMOKE)[4].where(~QI.FE.is_train(F.col("id"))).count())
    print("mirrored direction: MLlib", len(a), "own", len(b), "different", len(a ^ b), "of", n_test)
    assert len(a ^ b) <= 0.2 * n_test
