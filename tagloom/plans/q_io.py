"""Round trips through the reference's file formats, node dictionary, keys.

Each query writes Spark-derived data to a fresh folder under the session's
checkpoint folder and reads it back with the matching reader, so the result
must equal the SQL computed directly from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as X
from ..operators import tags as T
from ..session import scratch_path
from ..sources import sinks, tables
from . import q_scoring as QS
from .registry import register

# ---- delimited label counts (K4/K5, S9-S11, X19, P12) -----------------------


@register("delimited_roundtrip",
          "WITH " + QS.CLASSIFICATION_CTE.strip() + f"""
SELECT label, count(*) AS count FROM classification WHERE label <> '{C.NONE_LABEL}' GROUP BY label""",
          "K4,K8,S10,X19,P12")
def delimited_roundtrip_df(spark, sf_dir):
    counts = QS.label_counts_df(spark, sf_dir)
    path = scratch_path(spark, "label-counts")
    sinks.write_delimited(counts, path, "~", files=6)
    return tables.read_delimited(spark, path, tables.LABEL_COUNT_SCHEMA, "~")


@register("pair_json_roundtrip",
          "WITH " + QS.CLASSIFICATION_CTE.strip() + """
SELECT CAST(substr(image, 3) AS BIGINT) AS id, label, round(score, 6) AS score FROM classification""",
          "K3,K6,S2,S3,P2,X2")
def pair_json_roundtrip_df(spark, sf_dir):
    scores = QS.classification(spark, sf_dir)
    path = scratch_path(spark, "classification")
    sinks.write_json(scores, path)
    back = tables.read_scores(spark, path)
    return back.select(X.image_number(F.col("image")).alias("id"), "label", F.round("score", 6).alias("score"))


@register("label_list_roundtrip",
          "WITH " + QS.CLASSIFICATION_CTE.strip() + f"""
SELECT label FROM (SELECT label, count(*) AS c FROM classification WHERE label <> '{C.NONE_LABEL}'
                   GROUP BY label ORDER BY c DESC, label LIMIT {C.TOP_TAGS})""",
          "K1,K8,S4,P1")
def label_list_roundtrip_df(spark, sf_dir):
    top = QS.label_top50_df(spark, sf_dir).select("label")
    path = scratch_path(spark, "label-list")
    sinks.write_text(top, path, files=1)
    return tables.read_label_list(spark, path)


@register("original_tags_json",
          "SELECT doc_id AS id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS label FROM documents",
          "K2,K8,O3,S12,F12,P13")
def original_tags_json_df(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    original = T.original_tags(T.lines_from_text(docs, "doc_id", "text"))
    path = scratch_path(spark, "original-tags")
    sinks.write_json(original, path)
    return tables.read_pairs(spark, path)


# ---- node dictionary (S13, J6) ------------------------------------------------

def _dictionary_files(spark, sf_dir):
    """Writes the two dictionary files the scorer reads: ``uid<TAB>name`` lines
    and a ``target_class`` / ``target_class_string`` text proto, both derived
    from nation (node) and region (description)."""
    nation = tables.table(spark, sf_dir, "nation")
    region = tables.table(spark, sf_dir, "region")
    uid = F.concat(F.lit("n"), F.lpad(F.col("n_nationkey").cast("string"), 8, "0"))
    named = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    uid_lines = named.select(F.concat(uid, F.lit("\t"), F.col("n_name"), F.lit(", "), F.col("r_name")).alias("value"))
    proto = nation.select(F.array(
        F.lit("entry {"),
        F.concat(F.lit("  target_class: "), F.col("n_nationkey").cast("string")),
        F.concat(F.lit('  target_class_string: "'), uid, F.lit('"')),
        F.lit("}")).alias("block")).select(F.array_join("block", "\n").alias("value"))
    uid_path, proto_path = scratch_path(spark, "uid-names"), scratch_path(spark, "node-uids")
    sinks.write_text(uid_lines, uid_path)
    sinks.write_text(proto, proto_path)
    return uid_path, proto_path


def read_node_dictionary(spark, uid_path: str, proto_path: str):
    """(node_id, name) from the two files; a uid without a name is an error."""
    uid_names = (spark.read.text(uid_path)
                 .select(F.regexp_extract("value", "^([n0-9]*)\\t(.*)$", 1).alias("uid"),
                         F.regexp_extract("value", "^([n0-9]*)\\t(.*)$", 2).alias("name")))
    # One row per proto file (the file is bounded by the number of classes);
    # class ids and uids are extracted pairwise in block order.
    proto = spark.read.text(proto_path, wholetext=True)
    block = 'target_class: (\\d+)\\s*\\n\\s*target_class_string: "([^"]*)"'
    pairs = proto.select(F.explode(F.arrays_zip(
        F.regexp_extract_all("value", F.lit(block), 1).alias("node_id"),
        F.regexp_extract_all("value", F.lit(block), 2).alias("uid"))).alias("p")).select(
        F.col("p.node_id").cast("int").alias("node_id"), F.col("p.uid").alias("uid"))
    missing = pairs.join(uid_names, "uid", "left_anti").count()
    if missing:
        raise ValueError(f"{missing} node uids have no name")
    return pairs.join(uid_names, "uid").select("node_id", "name")


@register("label_dictionary",
          """SELECT n_nationkey AS node_id, n_name || ', ' || r_name AS name
             FROM nation JOIN region ON n_regionkey = r_regionkey""",
          "S13,J6,D11,D12")
def label_dictionary_df(spark, sf_dir):
    uid_path, proto_path = _dictionary_files(spark, sf_dir)
    return read_node_dictionary(spark, uid_path, proto_path)


# ---- key parsing (X1-X3, X23) -----------------------------------------------

@register("file_key_parse",
          """SELECT page_id,
                    'tags' || page_id || '.txt' AS tag_file,
                    string_split(string_split(string_split('/data/tags/tags' || page_id || '.txt', '/')[-1], '.')[1], 'tags')[-1] AS image,
                    CAST(string_split('im' || page_id, 'im')[2] AS BIGINT) AS image_number,
                    string_split(string_split(url, '/')[-1], '.')[1] AS url_base
             FROM pages""",
          "X1,X2,X3,X23")
def file_key_parse_df(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages").select("page_id", "url")
    path = F.concat(F.lit("/data/tags/tags"), F.col("page_id").cast("string"), F.lit(".txt"))
    return pages.select(
        "page_id",
        F.concat(F.lit("tags"), F.col("page_id").cast("string"), F.lit(".txt")).alias("tag_file"),
        X.tag_file_key(path).alias("image"),
        X.image_number(F.concat(F.lit("im"), F.col("page_id").cast("string"))).alias("image_number"),
        X.url_base_name(F.col("url")).alias("url_base"))
