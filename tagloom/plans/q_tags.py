"""Tag-analysis queries (tokeniser, stop words, counts, rankings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as X
from ..operators import features as FE
from ..operators import langid as L
from ..operators import tags as T
from ..sources import standins, tables
from . import sql_text as S
from .registry import register

LINES_SQL = ("SELECT doc_id AS image, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS label "
             "FROM documents")

METADATA_SQL = """
SELECT image, unnest(tags) AS label FROM (
  SELECT p_partkey AS image, [
    'geo:lat=' || CAST(p_size AS BIGINT) || '.' || lpad(CAST(p_partkey * 7919 % 1000000 AS VARCHAR), 6, '0'),
    'geo:lon=-' || CAST(p_size % 3 AS BIGINT) || '.' || lpad(CAST(p_partkey * 104729 % 100000 AS VARCHAR), 5, '0'),
    CAST(p_size AS BIGINT) || 'mm f/' || CAST(p_size % 9 + 1 AS BIGINT) || '.' || CAST(p_size % 10 AS BIGINT),
    CAST(p_size % 30 + 10 AS BIGINT) || '-' || CAST(p_size * 4 + 40 AS BIGINT) || 'mm',
    'Canon EOS ' || CAST(p_size AS BIGINT) || 'D',
    CAST(p_size % 80 + 10 AS BIGINT) || CAST(p_size + 100 AS BIGINT) || 'mm',
    lower(replace(p_brand, '#', '')) || ':)'] AS tags
  FROM part
  UNION ALL
  SELECT o_orderkey + 1000000, [
    strftime(o_orderdate, '%-d.%-m.%Y'),
    strftime(o_orderdate, '%d/%m/%Y'),
    CAST(o_orderkey % 1000 AS BIGINT) || ',' || CAST(o_custkey % 100 AS BIGINT),
    'f' || CAST(o_orderkey % 64 AS BIGINT)]
  FROM orders
  UNION ALL
  SELECT l_orderkey * 10 + l_linenumber + 10000000, [
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' off;-)',
    'sigma' || CAST(l_quantity AS BIGINT) || '-' || CAST(l_quantity AS BIGINT) * 10 || 'mm',
    'EF-S ' || CAST(l_linenumber AS BIGINT) || '.' || CAST(l_quantity AS BIGINT)]
  FROM lineitem)"""


def _not_in(values: list[str]) -> str:
    return "(" + ", ".join(S.q(v) for v in values) + ")"


def _tags_sql(select: str) -> str:
    return "WITH RECURSIVE " + S.normalized_tags_cte(LINES_SQL).strip() + "\n" + select


def _counts_sql(select: str) -> str:
    return _tags_sql(", counts AS (SELECT label_normalized, count(*) AS tag_count FROM tags "
                     "GROUP BY label_normalized)\n" + select)


TOP50_SQL = _counts_sql(f"""
SELECT label_normalized, tag_count FROM (
  SELECT * FROM (SELECT * FROM counts ORDER BY tag_count DESC, label_normalized LIMIT {C.TOP_TAGS_PREFILTER})
  WHERE label_normalized NOT IN {_not_in(C.NON_SIGNIFICANT_TAGS)}
  ORDER BY tag_count DESC, label_normalized LIMIT {C.TOP_TAGS})
ORDER BY label_normalized""")


def tag_top50_df(spark, sf_dir):
    tags = T.normalized_tags(standins.tag_lines(spark, sf_dir))
    return T.top_tags(T.tag_counts(tags))


register("tag_top50", TOP50_SQL, "S1,X4-X11,P5,F4,F5,A7,A1,O1,F3,D2")(tag_top50_df)


@register("tag_counts", _counts_sql("SELECT label_normalized, tag_count FROM counts"), "A1,K9")
def tag_counts_df(spark, sf_dir):
    return T.tag_counts(T.normalized_tags(standins.tag_lines(spark, sf_dir)))


@register("stopword_filter", _tags_sql("SELECT image, label_normalized FROM tags"), "F4,F5,J9,A7,P3")
def stopword_filter_df(spark, sf_dir):
    return T.normalized_tags(standins.tag_lines(spark, sf_dir))


@register("tokenize_tags",
          "WITH RECURSIVE " + S.tokens_cte(LINES_SQL).strip() + "\nSELECT image, token FROM tok",
          "X9,X10,X11,P5,A7")
def tokenize_tags_df(spark, sf_dir):
    return T.distinct_tokens(standins.tag_lines(spark, sf_dir))


@register("metadata_tag_tokens",
          "WITH RECURSIVE " + S.tokens_cte(METADATA_SQL).strip() + "\nSELECT image, token FROM tok",
          "X7,X8,X9,X10 on camera-style tags")
def metadata_tag_tokens_df(spark, sf_dir):
    return T.distinct_tokens(standins.metadata_tags(spark, sf_dir))


@register("metadata_tag_rewrite",
          f"SELECT image, label, array_to_string({S.rewrite_split(S.singular(S.fold('label')))}, ' ') AS words "
          f"FROM ({METADATA_SQL})",
          "X4,X5,X6,X7,X8,X9 (one step)")
def metadata_tag_rewrite_df(spark, sf_dir):
    tags = standins.metadata_tags(spark, sf_dir)
    return tags.select("image", "label", T.line_words(F.col("label")).alias("words"))


WORDS_SQL = "SELECT DISTINCT unnest(string_split_regex(text, '[ \\n]+')) AS word FROM documents"


def _words(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("text")
    return docs.select(F.explode(F.split("text", "[ \\n]+")).alias("word")).distinct()


@register("accent_fold", f"SELECT word, {S.fold_hangul('word')} AS folded FROM ({WORDS_SQL})", "X4,X5")
def accent_fold_df(spark, sf_dir):
    return _words(spark, sf_dir).select("word", X.fold(F.col("word")).alias("folded"))


@register("singularize_words",
          f"SELECT word, {S.singular(S.fold('word'))} AS singular FROM ({WORDS_SQL})", "X6")
def singularize_words_df(spark, sf_dir):
    return _words(spark, sf_dir).select("word", X.singular(X.fold(F.col("word"))).alias("singular"))


@register("raw_tag_lines", f"SELECT image AS id, label FROM ({LINES_SQL}) ORDER BY id", "S1,P1,P3,O3")
def raw_tag_lines_df(spark, sf_dir):
    return T.original_tags(standins.tag_lines(spark, sf_dir))


@register("tags_per_image",
          _tags_sql("SELECT image, count(*) AS n_tags, array_to_string(list_sort(list(label_normalized)), ' ') AS tags "
                    "FROM tags GROUP BY image"),
          "A4,O5,P4")
def tags_per_image_df(spark, sf_dir):
    return T.tags_per_image(T.normalized_tags(standins.tag_lines(spark, sf_dir)))


# Documents of 100 whose lines the language model learns from.
LANG_TRAIN_PERCENT = 20

# ---- language identification and histogram (L1, X12, A2, J8, A12, X15) ----

LANG_LINES_SQL = ("SELECT doc_id AS image, lang AS doc_lang, "
                  "unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS label, "
                  "generate_subscripts(string_split_regex(text, '\\r\\n|\\r|\\n'), 1) - 1 AS pos FROM documents")

TRAIN_SQL = (f"(((image % {FE.SPLIT_MODULUS}) * {FE.SPLIT_MULTIPLIER} + {FE.SPLIT_OFFSET}) % 100) < {LANG_TRAIN_PERCENT} "
             "AND doc_lang IS NOT NULL")

LANG_CTE = f"""WITH lines AS ({LANG_LINES_SQL}),
tris AS (SELECT image, pos, doc_lang, substr(' ' || lower(label) || ' ', i, 3) AS tri
         FROM lines, range(1, length(label) + 1) t(i) WHERE length(label) >= 1),
counts AS (SELECT tri, doc_lang AS lang, count(*) AS c FROM tris WHERE {TRAIN_SQL} GROUP BY tri, doc_lang),
model AS (SELECT tri, lang, ln(c + 1.0) AS w FROM counts),
vocab AS (SELECT count(DISTINCT tri) AS V FROM counts),
totals AS (SELECT lang, sum(c) AS N FROM counts GROUP BY lang),
priors AS (SELECT doc_lang AS lang, count(*) AS n_lines FROM lines WHERE {TRAIN_SQL} GROUP BY doc_lang),
langs AS (SELECT p.lang, ln(p.n_lines / (SELECT sum(n_lines) FROM priors)) AS prior,
                 ln(coalesce(t.N, 0) + (SELECT V FROM vocab)) AS norm
          FROM priors p LEFT JOIN totals t USING (lang)),
seen AS (SELECT t.image, t.pos, m.lang, sum(m.w) AS seen FROM tris t JOIN model m USING (tri)
         GROUP BY t.image, t.pos, m.lang),
scored AS (SELECT l.image, l.pos, g.lang,
                  round(g.prior - length(l.label) * g.norm + coalesce(s.seen, 0.0), 9) AS score
           FROM lines l CROSS JOIN langs g
           LEFT JOIN seen s ON s.image = l.image AND s.pos = l.pos AND s.lang = g.lang),
best AS (SELECT image, pos, lang FROM (
           SELECT *, row_number() OVER (PARTITION BY image, pos ORDER BY score DESC, lang) AS rn FROM scored)
         WHERE rn = 1)"""


def _language_lines(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return docs.select(F.col("doc_id").alias("image"), "lang",
                       F.posexplode(F.split("text", T.LINE_BREAK)).alias("pos", "label"))


def language_predictions(spark, sf_dir, train_percent: int = LANG_TRAIN_PERCENT):
    """Fits on the lines of a hash-chosen share of the labelled documents and
    predicts every line."""
    lines = _language_lines(spark, sf_dir)
    known = lines.where(FE.is_train(F.col("image"), train_percent) & F.col("lang").isNotNull())
    model, langs = L.train(known.select("lang", "label"))
    return L.predict(lines.select("image", "pos", "label"), model, langs, ["image", "pos"])


@register("language_identify", LANG_CTE + "\nSELECT image, pos, lang FROM best", "L1,X12,V2")
def language_identify_df(spark, sf_dir):
    return language_predictions(spark, sf_dir).select("image", F.col("pos").cast("bigint").alias("pos"), "lang")


def language_counts(spark, sf_dir):
    """(idioma, count): lines per predicted language."""
    return language_predictions(spark, sf_dir).groupBy(F.col("lang").alias("idioma")).agg(F.count(F.lit(1)).alias("count"))


LANG_COUNTS_SQL = LANG_CTE + "\nSELECT lang AS idioma, count(*) AS count FROM best GROUP BY lang"


def _names_sql() -> str:
    return "(VALUES " + ", ".join(f"({S.q(c)}, {S.q(n)})" for c, n in C.LANGUAGE_NAMES) + ") AS names(code, name)"


@register("language_histogram", LANG_CTE + f""",
hist AS (SELECT lang AS idioma, count(*) AS count FROM best GROUP BY lang)
SELECT h.idioma, h.count, names.name,
       CASE WHEN max(h.count) OVER () = min(h.count) OVER () THEN 12.0
            ELSE 12.0 + 88.0 * (h.count - min(h.count) OVER ()) / (max(h.count) OVER () - min(h.count) OVER ()) END AS size
FROM hist h LEFT JOIN {_names_sql()} ON names.code = h.idioma""",
          "A2,K5,S11,J8,A12,X15")
def language_histogram_df(spark, sf_dir):
    hist = language_counts(spark, sf_dir)
    names = spark.createDataFrame(C.LANGUAGE_NAMES, "code string, name string")
    named = hist.join(F.broadcast(names), hist.idioma == names.code, "left").drop("code")
    return T.rescaled_counts(named, "count", "size")
