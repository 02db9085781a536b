"""Tag normalisation: golden vectors (FIXTURES.md section 3) in Spark and in
the DuckDB twin, plus fixpoint properties."""

import pytest
from pyspark.sql import functions as F

from tagloom.functions import constants as C
from tagloom.functions import text as X
from tagloom.plans import sql_text as S

GOLDEN = [
    ("geo:lat=51.509806", ["geolat", "51"]), ("geo:lon=-0.076617", ["geolon"]),
    ("geo:lat=51.5", ["geo", "lat", "51.5"]), (":)", ["emoticono"]), (";-)", ["emoticono"]), (":-)", []),
    ("photo;-)", ["photoemoticono"]), ("1,5", ["1.5"]), ("1,234,5", ["234.5"]), ("f28", ["f28"]),
    ("f/2.8", ["f2", ".8"]), ("50mm f/1.8", ["50", "mm", "f1", ".8"]), ("2.2.2007", ["2-2-2007"]),
    ("25/12/2006", ["25-12-2006"]), ("1/500", ["500"]), ("canon400d", ["canon", "400"]),
    ("Canon EOS 40D", ["canon", "eo", "40"]), ("12-24mm", ["12-24mm"]), ("sigma10-20mm", ["sigma", "10-20mm"]),
    ("70-200mm/f2.8", ["70-200mm", "f2", ".8"]), ("1755mm", ["17-55mm"]), ("d80", ["80"]), ("20mm", ["20", "mm"]),
    ("a.b.c", []), ("foo..bar", ["foo", "bar"]), ("foo--bar", ["foo", "bar"]), ("EF-S 10-22mm", ["ef", "10", "22", "mm"]),
    ("10.20mm", ["10.20mm"]), ("2007", ["2007"]), ("-1", ["-1"]), ("don't", ["don't"]), ("b&w", ["b&w"]),
    ("BW", ["b&w"]), ("black &amp; white", ["black", "white"]), ("rock&amp;roll", ["rock&roll"]),
    ("tag:foo", ["tag", "foo"]), ("café_noir", ["cafe", "noir"]), ("São Paulo", ["sao", "paulo"]),
    ("naïve", ["naive"]), ("Straße", ["straße"]), ("Niños", ["nino"]), ("Cafés", ["cafe"]), ("Ñ", []), ("x", []),
    ("...", []), ("&amp;", []), ("x^2", []), ("", []), ("Trees", ["tree"]), ("cities", ["city"]), ("wolves", ["wolf"]),
    ("boxes", ["box"]), ("buses", ["bus"]), ("people", ["person"]), ("women", ["woman"]), ("data", ["datum"]),
    ("media", ["medium"]), ("glass", ["glass"]), ("news", ["news"]), ("series", ["series"]), ("status", ["status"]),
    ("crisis", ["crisis"]), ("this", ["thi"]),
]


def test_golden_vectors_spark(spark):
    df = spark.createDataFrame([(c,) for c, _ in GOLDEN], "x string")
    got = {r.x: list(r.t) for r in df.select("x", X.tokenize(F.col("x")).alias("t")).collect()}
    for raw, expected in GOLDEN:
        assert got[raw] == expected, raw


def test_golden_vectors_duckdb(duck):
    vals = ",".join(f"({i}, {S.q(c)})" for i, (c, _) in enumerate(GOLDEN))
    sql = ("WITH RECURSIVE " + S.tokens_cte(f"SELECT * FROM (VALUES {vals}) v(image, label)").strip()
           + " SELECT image, list(token ORDER BY token) FROM tok GROUP BY image")
    got = dict(duck.execute(sql).fetchall())
    for i, (raw, expected) in enumerate(GOLDEN):
        assert sorted(got.get(i, [])) == sorted(set(expected)), raw


def test_fold_table_is_derived_and_single_char():
    src, dst = C.accent_fold_table()
    assert len(src) >= len(dst) > 500
    assert "é" in src and dst[src.index("é")] == "e"


@pytest.mark.parametrize("word,folded", [
    ("ガーデン", "カテン"), ("한", "\u1112\u1161\u11ab"), ("가", "\u1100\u1161"), ("\uf900", "\u8c48"), ("\U0002f800", "\u4e3d"),
    ("Ángström", "angstrom")])
def test_fold_decomposes_every_script(spark, word, folded):
    import duckdb

    from tagloom.plans import sql_text as S
    assert spark.createDataFrame([(word,)], "w string").select(X.fold(F.col("w"))).first()[0] == folded
    assert duckdb.execute(f"SELECT {S.fold_hangul('w')} FROM (SELECT ? AS w)", [word]).fetchall()[0][0] == folded


def test_unfinished_word_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(X, "tokenize_state", lambda x: F.array(X._entry(x, False)))
    with pytest.raises(Exception, match="no fixpoint"):
        spark.createDataFrame([("w",)], "w string").select(X.tokenize(F.col("w"))).collect()


def test_stop_words_equal_the_published_list(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert C.ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


@pytest.fixture(scope="module")
def words(spark):
    from tagloom.sources import tables
    docs = tables.table(spark, "/root/testdata/sf0.001", "documents").select("text")
    return docs.select(F.explode(F.split("text", "[ \\n]+")).alias("word")).distinct()


def test_tokeniser_converges_on_all_words(words):
    state = words.select(X.tokenize_state(F.col("word")).alias("st"))
    assert state.where(~F.forall("st", lambda e: e["d"])).count() == 0


def test_tokens_are_fixpoints(words):
    toks = words.select(F.explode(X.tokenize(F.col("word"))).alias("t")).distinct()
    again = toks.select("t", X.tokenize(F.col("t")).alias("t2"))
    bad = again.where(~((F.size("t2") == 1) & (F.get("t2", 0) == F.col("t"))))
    assert bad.count() == 0


def test_singular_guard_matches_unguarded(spark, words):
    """The last-character guard never changes a result."""
    from pyspark.sql import Column  # noqa: F401

    def unguarded(c):
        expr = F.when(c.rlike(X._uncountable_pattern()), c)
        for pattern, repl in C.SINGULAR_RULES:
            expr = expr.when(c.rlike(pattern), F.regexp_replace(c, pattern, repl))
        return expr.otherwise(c)
    folded = words.select(X.fold(F.col("word")).alias("w"))
    diff = folded.where(X.singular(F.col("w")) != unguarded(F.col("w")))
    assert diff.count() == 0


def test_scalar_helpers(spark):
    row = spark.range(1).select(
        X.tag_file_key(F.lit("file:/a/b/tags123.txt")).alias("k"),
        X.image_number(F.lit("im999")).alias("n"),
        X.url_base_name(F.lit("http://h/x/im7.jpg")).alias("b"),
        X.classification_line(F.lit("u"), F.lit("cat"), F.lit(0.123456)).alias("line"),
        X.hit_rate(F.lit(2), F.lit(3)).alias("rate"),
        X.rescale(F.lit(5), F.lit(5), F.lit(5)).alias("flat"),
    ).first()
    assert row.k == "123" and row.n == 999 and row.b == "im7"
    assert row.line == "u|cat|12.35" and row.rate == 66.67 and row.flat == 12.0


def test_spread_deals_out_and_keeps_all_rows(spark):
    from tagloom.session import spread
    narrow = spark.range(0, 1000, numPartitions=1)
    for dealt in (spread(narrow), spread(narrow, "id")):
        assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert sorted(r.id for r in dealt.collect()) == list(range(1000))


def test_short_way_gives_the_same_tokens(spark, words):
    odd = ["bw", "bw.", "bws", "canon", "canons", "as", "as.", "oxen", "buses", "ss", "series", "news.", "a", "men", "xs", "it.."]
    every = words.union(spark.createDataFrame([(w,) for w in odd], "word string"))
    import re
    for w in ["children", "women", "people", "mice", "oxen", "oxenx", "data", "media", "octopi", "viri"]:
        assert re.search(X._NOT_S, w)
    kept = every.where(~F.col("word").endswith("s") & ~F.lower("word").rlike(X._NOT_S))
    assert kept.where(X.singular(F.lower("word")) != F.lower("word")).collect() == []
    different = every.select("word", X.tokens(F.col("word")).alias("a"), X.tokenize(F.col("word")).alias("b")).where("a <> b")
    assert different.collect() == []
