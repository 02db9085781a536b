"""Tag words by tasks that keep what they have seen: same tokens as the expressions,
shuffles that grow with the lines."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from tagloom.functions import tag_words as W
from tagloom.functions import text as X
from tagloom.operators import tags as T

FRAGMENTS = ["canon", "mm", "f", "geo:", "lat", "=", "-", ".", "..", "--", "/", ",", ";", ")", "P", "0", "12", "345", "6789", "&amp;", "bw",
             " ", "\t", "s", "ies", "men", "oxen", "matrices", "news", "ss", "é", "ß", "^", "`", "#", "\x0b", "ΟΔΟΣ", "İ", "й", "ガ", "한", "中",
             "ก", " ", "\r", "wolves", "people", "series", "1.5", "10-20mm", "1755mm", "don't", "%%%"]


def _odd_labels():
    rng = random.Random(3)
    made = {"".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(1, 7))) for _ in range(1500)}
    return [*sorted(made), "x" * 200 + " trees", "a" * 70, "", None]


def test_same_tokens_and_words_as_the_expressions(spark):
    label = F.col("label")
    lines = spark.createDataFrame([(x,) for x in _odd_labels()], "label string")
    got = lines.select("label", T.line_tokens(label).alias("a"), X.line_tokens(label).alias("b"), T.line_words(label).alias("v"),
                       F.array_join(X.rewrite_split(X.singular(X.fold(label))), " ").alias("w"))
    assert got.where("not (a <=> b) or not (v <=> w)").collect() == []


def test_unsettled_characters_are_left_to_the_expressions():
    assert W.line_tokens("กข trees") is None and W.line_tokens("a\rbc") is None
    assert W.line_tokens("Trees ガーデン") == ["tree", "カテン"]


def test_both_shuffles_grow_with_the_characters(spark, monkeypatch):
    made = spark.range(400).select(F.col("id").alias("image"), F.lit("some Trees").alias("label"))
    odd = spark.createDataFrame([(1, "tree"), (None, "tree"), (None, "tree"), (2, None)], "image long, label string")
    lines = made.unionByName(odd)
    few = T.normalized_tags(lines).rdd.getNumPartitions()
    monkeypatch.setattr(T, "PARTITION_CHARACTERS", 400 * 10 // (few + 5))
    tags = T.normalized_tags(lines)
    plan = tags._jdf.queryExecution().executedPlan().toString()
    assert tags.rdd.getNumPartitions() >= few + 5
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
    assert sorted(map(str, tags.collect())) == sorted(map(str, made.select("image", F.lit("tree").alias("label_normalized")).union(
        spark.createDataFrame([(None, "tree")], "image long, label_normalized string")).collect()))


def test_lines_split_at_every_kind_of_break(spark):
    texts = [(1, "a\r\nb\rc\nd"), (2, "\r\r\n\n"), (3, ""), (4, None), (5, "x\n")]
    docs = spark.createDataFrame(texts, "k long, t string")
    want = docs.select("k", F.explode(F.split("t", T.LINE_BREAK)))
    assert sorted(T.lines_from_text(docs, "k", "t").collect()) == sorted(want.collect())


def test_words_once_seen_cost_no_rules(monkeypatch):
    W.tokens.cache_clear()
    first = W.line_tokens("photos trees of")
    monkeypatch.setattr(W, "singular", lambda s: s if s.startswith("photos trees") else 1 / 0)
    assert W.line_tokens("photos trees of") == first == ["photo", "tree", "of"]


def test_lines_of_several_parts_have_the_tokens_of_the_expressions(spark):
    rng = random.Random(5)
    words = ["Haanth.", "that", "The", "stings", "testes", "jeans", "fishes", "women", "ciónboído", "ía", "data", "media", "großer.", "été,", "oxen", "canons", "bw", "of", "a",
             "re-do", "..a", "u.s.", "f/2", "12", "peoples", "^", "^s", "kisses", "Ía", "novia", "cacti", "viri", "CANON", "series", "no.", "Æs", "straßen", "ΟΔΟΣ", "กข", "--", "\x01", "¿qué?", "x,y"]
    made = [rng.choice(["", " "]) + " ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) + rng.choice(["", "", ".", " "]) for _ in range(1500)]
    lines = spark.createDataFrame([(x,) for x in [*made, *words, "a" * 70 + " trees", None]], "label string")
    got = lines.select("label", T.line_tokens(F.col("label")).alias("a"), X.line_tokens(F.col("label")).alias("b"))
    assert got.where("not (a <=> b)").collect() == []


def test_plain_words_are_looked_up_without_the_rules(monkeypatch):
    monkeypatch.setattr(W, "line_part", lambda c: 1 / 0)
    got = W.tokens_of_lines(pa.array(["Haanth thatrent, réreai trees onion thatrent.", None]))
    assert got.to_pylist() == [["haanth", "thatrent", "rereai", "tree", "onion", "thatrent."][:5], None]


def test_tokens_are_exploded_by_compiled_code(spark):
    lines = spark.createDataFrame([(1, "some Trees")], "image long, label string")
    plan = T.tokenize_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.splitlines() if "Generate explode(tokens" in x]
