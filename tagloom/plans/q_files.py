"""Queries over files that Spark writes from the tables: tag files, stored
binaries, the language histogram file, stored models and sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import distinct_counts as D
from ..operators import langid as L
from ..operators import scoring as SC
from ..operators import tags as T
from ..session import scratch_path
from ..sources import sinks, standins, tables
from ..streaming import posts as P
from . import q_scoring as QS
from . import q_streaming as QT
from .q_tags import LANG_COUNTS_SQL, language_counts
from .registry import register

# ---- one tag file per image (S1) ----------------------------------------------


def tag_files(spark, sf_dir) -> str:
    """Every document's lines as the file ``tags<doc_id>.txt``."""
    lines = standins.tag_lines(spark, sf_dir).withColumn("name", F.concat(F.lit("tags"), F.col("image").cast("string"), F.lit(".txt")))
    path = scratch_path(spark, "tag-files")
    sinks.write_named_texts(lines, path, "name", "label", folders=False)
    return path


@register("tag_file_scan",
          "SELECT CAST(doc_id AS VARCHAR) AS image, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS label FROM documents",
          "S1,X1,D5,D8")
def tag_file_scan_df(spark, sf_dir):
    return tables.read_tag_files(spark, tag_files(spark, sf_dir))


# ---- stored binaries (S6, S7) -----------------------------------------------------

# One of eight files is cut off in the middle, so it cannot be read as a vector.
BROKEN_EVERY = 8


def stored_vectors(spark, sf_dir) -> str:
    """Every vector as the file ``im<vec_id>.jpg`` (its stand-in for an image)."""
    numbers = F.array_join(F.transform("embedding", lambda v: v.cast("string")), ",")
    cut = F.pmod("vec_id", F.lit(BROKEN_EVERY)) == BROKEN_EVERY - 1
    vectors = tables.table(spark, sf_dir, "embeddings").where("embedding is not null").select(
        F.concat(F.lit("im"), F.col("vec_id").cast("string"), F.lit(".jpg")).alias("name"),
        F.when(cut, F.concat(F.substring(numbers, F.lit(1), F.floor(F.length(numbers) / 2).cast("int")), F.lit(",?"))).otherwise(numbers).alias("value"))
    path = scratch_path(spark, "stored-vectors")
    sinks.write_named_texts(vectors, path, "name", "value")
    return path


STORED_CTE = "WITH " + QS.SCORES_CTE.strip() + f""",
listed AS (SELECT unnest(range(n + n // 4)) AS id FROM (SELECT max(vec_id) + 1 AS n FROM embeddings)),
readable AS (SELECT * FROM named WHERE vec_id % {BROKEN_EVERY} <> {BROKEN_EVERY - 1} AND rank <= {C.MAX_SCORE_LABELS}),
classification AS (SELECT l.id, coalesce(r.label, '{C.NONE_LABEL}') AS label, coalesce(r.prob, {C.NONE_SCORE}) AS score
                   FROM listed l LEFT JOIN readable r ON r.vec_id = l.id)"""


def stored_classification(spark, sf_dir):
    """(id, label, score): a listing that is a quarter longer than the stored
    images, scored from their files."""
    n = (tables.table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] or 0) + 1
    contents = tables.read_stored_vectors(spark, stored_vectors(spark, sf_dir))
    return SC.classify_images(spark.range(n + n // 4), contents, QS.model(spark, sf_dir), QS.dictionary(spark, sf_dir), "id")


@register("stored_image_scores", STORED_CTE + "\nSELECT id, label, round(score, 6) AS score FROM classification",
          "S6,F14,D6,D9 (files: whole, broken, absent)")
def stored_image_scores_df(spark, sf_dir):
    return stored_classification(spark, sf_dir).select("id", "label", F.round("score", 6).alias("score"))


@register("unscored_stored_images", STORED_CTE + f"\nSELECT 'im' || id AS image FROM classification WHERE label = '{C.NONE_LABEL}'",
          "F2,K1")
def unscored_stored_images_df(spark, sf_dir):
    none = stored_classification(spark, sf_dir).where(F.col("label") == C.NONE_LABEL)
    path = scratch_path(spark, "unscored")
    sinks.write_text(none.select(F.concat(F.lit("im"), F.col("id").cast("string")).alias("value")), path, files=3)
    return spark.read.text(path).select(F.col("value").alias("image"))


@register("stream_stored_images", QT.STREAM_CTE + f"""
SELECT url, label, pct FROM lines
WHERE TRY_CAST(string_split(string_split(string_split(url, '/')[-1], '.')[1], 'im')[2] AS BIGINT) % {BROKEN_EVERY} <> {BROKEN_EVERY - 1}""",
          "S7,T4 (files; absent and broken ones drop)")
def stream_stored_images_df(spark, sf_dir):
    contents = tables.read_stored_vectors(spark, stored_vectors(spark, sf_dir)).withColumnRenamed("id", "vec_id")
    out = scratch_path(spark, "stream-stored")
    P.run_classification_stream(spark, QT._feed(spark, sf_dir), contents, SC.model_row(QS.model(spark, sf_dir)),
                                QS.dictionary(spark, sf_dir), out, scratch_path(spark, "stream-stored-ckpt"), files_per_trigger=64)
    return P.parse_lines(spark.read.schema("value string").text(out))


# ---- classes without a name (F14) ---------------------------------------------------

UNNAMED_SQL = "WITH " + QS.SCORES_CTE.strip() + f"""
SELECT vec_id, rank, CASE WHEN node % 3 = 0 THEN '' ELSE label END AS label FROM named WHERE rank <= {C.MAX_SCORE_LABELS}"""


@register("unnamed_classes", UNNAMED_SQL, "F14 (a third of the classes has no name)")
def unnamed_classes_df(spark, sf_dir):
    vectors = tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    known = QS.dictionary(spark, sf_dir).where("node_id % 3 <> 0")
    scored = SC.name_nodes(SC.score_vectors(vectors, QS.model(spark, sf_dir), "vec_id"), known)
    return scored.select("vec_id", F.col("rank").cast("bigint").alias("rank"), "label")


# ---- the language histogram as a file (S11, K5) ---------------------------------------


@register("language_file_roundtrip", LANG_COUNTS_SQL, "K5,S11,A2")
def language_file_roundtrip_df(spark, sf_dir):
    path = scratch_path(spark, "languages")
    sinks.write_delimited(language_counts(spark, sf_dir), path, ",", files=3, order=["idioma"])
    return tables.read_language_counts(spark, path)


# ---- distinct counts from stored sketches (A11) -----------------------------------------


@register("distinct_lines_sketch", f"""
WITH l AS (SELECT source, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
SELECT coalesce(source, '') AS source, count(DISTINCT line) AS n_lines, true AS within FROM l GROUP BY 1
UNION ALL SELECT '*', count(DISTINCT line), true FROM l""", "A11 (mergeable sketch; exact beside it)")
def distinct_lines_sketch_df(spark, sf_dir):
    """Each source's number of distinct lines, and all sources' together (``*``);
    ``within``: the estimate from the stored sketches is within four standard
    errors of it."""
    docs = tables.table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("source"), "text")
    lines = T.lines_from_text(docs, "source", "text").select(F.col("image").alias("source"), F.col("label").alias("line"))
    path = scratch_path(spark, "line-sketches")
    D.sketches(lines, "source", "line").write.parquet(path)
    parts = spark.read.parquet(path)
    estimates = D.merged(parts, "source").unionByName(D.merged(parts).select(F.lit("*").alias("source"), "estimate"))
    exact = (lines.groupBy("source").agg(F.count_distinct("line").alias("n_lines"))
             .unionByName(lines.agg(F.count_distinct("line").alias("n_lines")).select(F.lit("*").alias("source"), "n_lines")))
    near = F.abs(F.col("estimate") - F.col("n_lines")) <= F.col("n_lines") * 4 * D.STANDARD_ERROR + 1
    return exact.join(estimates, "source").select("source", "n_lines", near.alias("within"))
