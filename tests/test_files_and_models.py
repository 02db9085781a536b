"""Writers, stored files and models, quantile bins, sketches."""

import glob
import gzip
import os
import zlib

import pytest
from pyspark.sql import functions as F

from tagloom.functions import constants as C
from tagloom.operators import distinct_counts as D
from tagloom.operators import features as FE
from tagloom.operators import model_store as MS
from tagloom.operators import scoring as SC
from tagloom.operators import trees as TR
from tagloom.plans import q_files as QF
from tagloom.plans import q_scoring as QS
from tagloom.session import scratch_path
from tagloom.sources import sinks, tables

from .conftest import SF_SMOKE


def _files(path):
    return sorted(glob.glob(path.replace("file:", "") + "/part-*"))


@pytest.mark.parametrize("files", [1, 4])
def test_sorted_files_hold_the_global_order(spark, files):
    df = spark.range(0, 20_000, 1, 11).select((F.col("id") * 7919 % 20_011).alias("id"), F.concat(F.lit("l"), F.col("id").cast("string")).alias("label"))
    path = scratch_path(spark, "sorted")
    sinks.write_json(df, path, files, order=["id"])
    parts = [[r.id for r in spark.read.schema("id long, label string").json(f).collect()] for f in _files(path)]
    assert len(parts) == files and min(map(len, parts)) > 20_000 // files // 3
    assert sum(parts, []) == sorted(r.id for r in df.collect())


def test_a_common_value_spans_sorted_files(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).cast("long").alias("id"), F.col("id").cast("string").alias("label"))
    parts = sinks.arranged(df, 6, ["id"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).orderBy("p").collect()
    assert len(parts) == 6 and max(p.n for p in parts) < 30_000 // 3
    assert all(x.b <= y.a for x, y in zip(parts, parts[1:]))


def test_the_file_count_does_not_narrow_the_work_before_it(spark):
    upstream = spark.range(0, 1000, 1, 13).select("id", F.spark_partition_id().alias("task"))
    out = sinks.arranged(upstream.where("id >= 0"), 2)
    assert out.select("task").distinct().count() == 13
    path = scratch_path(spark, "few")
    sinks.write_text(upstream.select(F.col("id").cast("string").alias("value")), path, files=2)
    assert len(_files(path)) == 2


def test_named_files_have_one_file_each(spark):
    rows = [("tags1.txt", "a"), ("tags1.txt", ""), ("tags22.txt", "b c"), ("tags1.txt", "é")]
    path = scratch_path(spark, "named")
    sinks.write_named_texts(spark.createDataFrame(rows, "n string, v string"), path, "n", "v")
    assert sorted((r.image, r.label) for r in tables.read_tag_files(spark, path).collect()) == [("1", ""), ("1", "a"), ("1", "é"), ("22", "b c")]
    assert len(glob.glob(path.replace("file:", "") + "/*/part-*")) == 2


def test_named_files_are_all_that_is_written(spark):
    rows = [("tags1.txt", "a"), (None, "n"), ("", "e"), ("tags2.txt", None), ("a/b:c.txt", "x")] + [(f"tags{i}.txt", "v") for i in range(100, 300)]
    path = scratch_path(spark, "named")
    df = spark.createDataFrame(rows, "n string, v string").repartition(3)
    sinks.write_named_texts(df, path, "n", "v")
    found = glob.glob(path.replace("file:", "") + "/**/*", recursive=True, include_hidden=True)
    files = sorted(f.split("/file=")[1].split("/")[0] for f in found if os.path.isfile(f))
    assert files == sorted([f"tags{i}.txt" for i in [1, 2, *range(100, 300)]] + ["__HIVE_DEFAULT_PARTITION__", "a%2Fb%3Ac.txt"])
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(["a", "n", "e", "", "x"] + ["v"] * 200)


def test_stored_vectors_that_cannot_be_read_are_null(spark, tmp_path):
    for name, body in {"im1.jpg": b"1.5,2,-3e-2\n", "im2.jpg": b"1.5,,2", "im3.jpg": b"\xff\xfe\x00", "im4.jpg": b"", "im5.jpg": b"1,2", "x.jpg": b"1,2,3"}.items():
        (tmp_path / name).write_bytes(body)
    got = {r.id: r.embedding for r in tables.read_stored_vectors(spark, str(tmp_path), 3).collect()}
    assert got[1] == pytest.approx([1.5, 2.0, -0.03], abs=1e-6)
    assert {k: v for k, v in got.items() if k not in (1, None)} == {2: None, 3: None, 5: None}  # an empty file is no file to Spark
    model = spark.createDataFrame([(0, [0.0] * 3), (1, [1.0] * 3)], "node int, centroid array<double>")
    names = spark.createDataFrame([(1, "one")], "node_id int, name string")
    index = spark.createDataFrame([(i,) for i in (1, 2, 9)], "id long")
    out = SC.classify_images(index, tables.read_stored_vectors(spark, str(tmp_path)).where("id is not null"), model, names, "id").collect()
    assert {r.label for r in out if r.id in (2, 9)} == {C.NONE_LABEL} and {r.label for r in out if r.id == 1} == {"", "one"}


def test_queries_share_one_fit(spark, monkeypatch):
    QS.model(spark, SF_SMOKE).count()
    monkeypatch.setattr(SC, "centroid_model", lambda *a: pytest.fail("fitted again"))
    assert QS.score_topk_df(spark, SF_SMOKE).count() > 0
    assert QF.unnamed_classes_df(spark, SF_SMOKE).count() > 0


def test_a_changed_training_file_is_a_new_version(spark, tmp_path):
    data, folder = str(tmp_path / "data"), str(tmp_path / "models")
    fitted = []

    def fit():
        fitted.append(1)
        return spark.read.parquet(data).agg(F.sum("id").alias("s"))

    def model():
        training = spark.read.parquet(data)
        return MS.stored(spark, "sum", MS.training_version(training, 1.5), fit, folder).first().s
    spark.range(10).write.parquet(data)
    assert (model(), model(), len(fitted)) == (45, 45, 1)
    spark.range(20).write.mode("overwrite").parquet(data)
    assert (model(), model(), len(fitted)) == (190, 190, 2)
    assert len(os.listdir(tmp_path / "models" / "sum")) == 2
    assert MS.training_version(spark.read.parquet(data), 1.5) != MS.training_version(spark.read.parquet(data), 2.5)


def test_batch_scorer_leaves_odd_vectors_out(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.1]), (3, None), (4, [0.1, None]), (5, [float("nan"), 0.0]), (6, []), (7, [0.3, 0.1, 0.2])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = spark.createDataFrame([(0, [0.0, 0.5]), (1, [1.0, 0.2])], "node int, centroid array<double>")
    names = spark.createDataFrame([(0, "zero"), (1, "one")], "node_id int, name string")
    batch = {(r.image, r.rank, r.label, r.score) for r in QS.batch_scored(vectors, model, names).collect()}
    native = SC.name_nodes(SC.score_vectors(vectors, model, "vec_id"), names)
    assert batch == {(f"im{r.vec_id}", r["rank"], r.label, round(r.prob, 6)) for r in native.collect()} and len(batch) == 2


def test_quantile_sketches_add_up_to_the_rule(spark):
    rows = [(i, f, ((i * 37 + f * 11) % 1000) / 1000) for i in range(900) for f in range(3) if (i + f) % (f + 2)]
    feats = spark.createDataFrame(rows, "id long, f long, v double")
    whole = TR.quantile_sketch(feats)
    parts = TR.merged_sketches(*[TR.quantile_sketch(feats.where(F.pmod("id", F.lit(3)) == k)) for k in range(3)])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    got = {r.f: r["cells"] for r in TR.quantile_thresholds(parts, 900).collect()}
    for f in range(3):
        values = sorted([v for _, g, v in rows if g == f] + [0.0] * (900 - sum(g == f for _, g, _ in rows)))
        cells = [int(-(-v * TR.SCORE_CELLS // 1)) for v in values]
        want = sorted({cells[-(-j * 900 // TR.QUANTILES) - 1] for j in range(1, TR.QUANTILES)})
        assert got[f] == want
    bins = TR.quantile_bins(feats, spark.range(900)).groupBy("f").agg(F.max("bin").alias("b")).collect()
    assert max(r.b for r in bins) <= TR.QUANTILES - 1


def test_forest_equals_a_plain_tree(spark):
    """Against one-row-at-a-time training in Python: several targets, an image
    without features, one without positives, a feature of test images only."""
    def plain(rows, names, depth):
        out = set()
        for t in names:
            def grow(train, test, level):
                n, n1 = len(train), sum(t in r[2] for r in train)
                best = None
                if level < depth and 0 < n1 < n:
                    def gini(a, b):
                        return 1.0 - (b / a) * (b / a) - (1.0 - b / a) * (1.0 - b / a)
                    for f in range(9):
                        for j in range(1, 4):
                            right = [r for r in train if r[1].get(f, 0) >= j]
                            a, b = len(right), sum(t in r[2] for r in right)
                            if 0 < a < n:
                                gain = round(gini(n, n1) - (n - a) / n * gini(n - a, n1 - b) - a / n * gini(a, b), TR.GAIN_DECIMALS)
                                if gain > 0 and (best is None or (-gain, f, j) < best):
                                    best = (-gain, f, j)
                if best is None:
                    out.update((r[0], t) for r in test if 2 * n1 > n)
                    return
                for side in (True, False):
                    def keep(r, side=side):
                        return (r[1].get(best[1], 0) >= best[2]) == side
                    grow(list(filter(keep, train)), list(filter(keep, test)), level + 1)
            grow([r for r in rows if r[3]], [r for r in rows if not r[3]], 0)
        return out
    data = []
    for i in range(400):
        x = {f: (i * (f + 3) + i * i // 7) % 4 for f in range(8)}
        x = {f: b for f, b in x.items() if b}
        y = {t for t, on in (("a", x.get(0, 0) > 1 and x.get(3, 0) < 2), ("b", (i % 7 < 3) ^ (x.get(5, 0) > 2)), ("c", False)) if on}
        data.append((i, x, y))
    data.append((400, {}, {"a"}))
    ids = spark.createDataFrame([(i,) for i, _, _ in data], "id long")
    train = {r.id: r.t for r in ids.select("id", FE.is_train(F.col("id")).alias("t")).collect()}
    data = [(i, x | ({8: 3} if not train[i] and i % 5 == 0 else {}), y, train[i]) for i, x, y in data]
    binned = spark.createDataFrame([(i, f, b) for i, x, _, _ in data for f, b in x.items()], "id long, f long, bin int")
    truth = spark.createDataFrame([(i, t) for i, _, y, _ in data for t in y] + [(3, "other")], "id long, label string")
    for depth in (1, 5):
        images = TR.image_rows(ids, binned, truth, ["a", "b", "c"])
        got = {(r.id, r.label) for r in TR.predicted_pairs(TR.train(images, ["a", "b", "c"], depth), images, depth).collect()}
        assert got == plain(data, ["a", "b", "c"], depth)
        assert got or depth == 1


def test_forest_of_nothing(spark):
    none = spark.createDataFrame([], "id long, f long, bin int")
    images = TR.image_rows(spark.range(50), none, spark.createDataFrame([], "id long, label string"), [])
    assert TR.predicted_pairs(TR.train(images, [], 2), images, 2).collect() == []
    images = TR.image_rows(spark.range(0), none, spark.createDataFrame([], "id long, label string"), ["a"])
    assert TR.predicted_pairs(TR.train(images, ["a"], 2), images, 2).collect() == []


def test_sketches_of_parts_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 20_000).cast("string").alias("v"))
    parts = D.sketches(df, "day", "v")
    assert parts.count() == 7
    total = D.merged(parts).first().estimate
    assert abs(total - 20_000) <= 4 * D.STANDARD_ERROR * 20_000
    assert D.merged(parts.limit(0)).first().estimate in (0, None)


def test_tag_files_are_listed_by_tasks_as_spark_reads_them(spark, tmp_path, monkeypatch):
    root = tmp_path / "tags"
    bodies = {"a/tags1.txt": b"x\r\ny\rz\n\nlast", "a/tags2.txt": b"", "file=tags3.txt/part-0.txt": b"\n", "tags4.txt": b"\xef\xbb\xbfm\n", "b/c/tags 5%41.txt": b"\xc3\xa9\n\xff",
              "a/_tags6.txt": b"no", "a/.tags7.txt": b"no", "_b/tags8.txt": b"no", "b/tags9.txt": b"\xef\xbb\xbf", "b/c=d/tags10.txt": b"p\n"}
    for name, body in bodies.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(body)
    (root / "b/tags11.txt.gz").write_bytes(gzip.compress(b"packed\nlines\n" * 2))
    import tagloom.sources.tables as TA
    theirs = TA._named_files(spark, "text", str(root), None).select(TA.X.tag_file_key(TA.file_name(F.col("_metadata.file_path"))).alias("image"), F.col("value").cast("binary").alias("b"))
    want = sorted((r.image, bytes(r.b)) for r in theirs.collect())
    monkeypatch.setattr(TA, "_named_files", lambda *a: pytest.fail("listed in the driver"))
    got = sorted((r.image, bytes(r.b)) for r in tables.read_tag_files(spark, str(root)).select("image", F.col("label").cast("binary").alias("b")).collect())
    assert got == want and len(got) == 14


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 64])
def test_pieces_of_a_file_hold_each_line_once(tmp_path, monkeypatch, piece):
    import tagloom.sources.tables as TA
    monkeypatch.setattr(TA, "_PIECE", piece)
    for body in (b"ab\r\n\r\ncd\re\n\nf", b"\n\r\r\n\n", b"abcdefgh", b"\xef\xbb\xbfab\ncd\n", b"\r\n" * 5, b"a\r"):
        path = tmp_path / f"tags{len(body)}.txt"
        path.write_bytes(body)
        size = len(body)
        got = [x for start in range(0, size, piece) for x in TA._lines_of(str(path), start, min(size, start + piece))]
        assert got == body.removeprefix(b"\xef\xbb\xbf").splitlines()


def test_tag_files_have_no_folder_of_their_own(spark, tmp_path):
    rows = [(f"tags{i}.txt", f"v{i}") for i in range(50)] + [("_odd.txt", "o"), (".dot.txt", "d"), ("part-1", "p"), (None, "n"), ("a/b.txt", "s")]
    path = scratch_path(spark, "flat")
    sinks.write_named_texts(spark.createDataFrame(rows, "n string, v string"), path, "n", "v", folders=False)
    files = [f for f in glob.glob(path.replace("file:", "") + "/**/*", recursive=True, include_hidden=True) if os.path.isfile(f)]
    assert len(files) == 55 and sum("/file=" in f for f in files) == 4
    assert len({os.path.dirname(f) for f in files if "/file=" not in f}) < 50
    assert sorted(r.label for r in tables.read_tag_files(spark, path).collect()) == sorted(v for _, v in rows)


def test_tag_files_that_only_spark_unpacks(spark, tmp_path):
    (tmp_path / "tags1.txt").write_bytes(b"a\n")
    (tmp_path / "tags2.txt.deflate").write_bytes(zlib.compress(b"b\nc\n"))
    assert sorted((r.image, r.label) for r in tables.read_tag_files(spark, str(tmp_path)).collect()) == [("1", "a"), ("2", "b"), ("2", "c")]
