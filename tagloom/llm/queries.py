"""The queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.tables import table
from . import (ann_forest, conversation_repair, decontamination, language_id, line_dedup, mixing, near_dedup, packing,
               quality_rules, secret_crf, spelling, token_count, url_filter)


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file (a parameter of the operators)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def near_duplicates(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def languages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def neighbours(spark, sf_dir):
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def packs(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secret_crf.scan(docs, secret_crf.train(docs))


def token_counts(spark, sf_dir):
    # The cache stays: a later run finds the counts of the texts it has met.
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                                    checkpoint_dir(spark).rstrip("/") + "/tagloom-token-counts")


def quality(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def url_filters(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def line_dedups(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


def mixture(spark, sf_dir):
    return mixing.plan(table(spark, sf_dir, "documents"))


def conversation_repairs(spark, sf_dir):
    return conversation_repair.report(conversation_repair.damaged(table(spark, sf_dir, "conversations")), "gone").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def leaks(spark, sf_dir):
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def spellings(spark, sf_dir):
    runs = spelling.runs(table(spark, sf_dir, "documents"))
    words = runs.select(spelling.slipped(F.col("doc_id"), F.col("run")).alias("word"))
    return spelling.variants(spelling.vocabulary(words))


QUERIES = {
    "op1_near_dedup": near_duplicates,
    "op2_language_id": languages,
    "op4_packing": packs,
    "op5_ann_forest": neighbours,
    "op6_secret_crf": secrets,
    "op7_token_counts": token_counts,
    "op3_quality_rules": quality,
    "op8_url_filters": url_filters,
    "op9_line_dedup": line_dedups,
    "op10_mixing": mixture,
    "op11_conversation_repair": conversation_repairs,
    "op12_decontamination": leaks,
    "op13_spelling_variants": spellings,
}

_LIT = lambda s: "'" + s.replace("'", "''") + "'"

QUALITY_SQL = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n,
             len(regexp_extract_all(line, '[!?*#$%&<>]')) AS marks,
             len(list_filter(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), lambda x: regexp_full_match(x, '[|>/»›·•-]+'))) AS seps
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)),
judged AS (SELECT *, marks >= n * {quality_rules.MARKS_PER_WORD}
                     OR (n >= {quality_rules.LONG_LINE} AND NOT regexp_matches(line, '{quality_rules.SENTENCE_MARKS}'))
                     OR (seps >= 2 AND seps >= n * {quality_rules.SEPARATOR_SHARE})
                     OR (n <= {quality_rules.BOILERPLATE_WORDS}
                         AND regexp_matches(lower(line), {_LIT(quality_rules.BOILERPLATE)})) AS bad
           FROM l WHERE n > 0),
per_doc AS (SELECT doc_id, CAST(coalesce(sum(CASE WHEN bad THEN n END), 0) AS BIGINT) AS lost_words,
                   count(*) - count(DISTINCT line) AS n_dup_lines FROM judged GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
        FROM w, unnest(range(1, len(ws) - 6)) AS t(i)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cover AS (SELECT doc_id, CAST(sum(least(8, coalesce(i - before, 8))) AS BIGINT) AS n_repeat_words
          FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM again) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             len(regexp_extract_all(text, '{quality_rules.SYMBOLS}')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(lost_words, 0) AS lost_words
      FROM w LEFT JOIN per_doc USING (doc_id) LEFT JOIN cover USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words)
       AND lost_words <= n_words * {quality_rules.MAX_LOST} AS kept, lost_words
FROM m"""


def _rules_sql(rules):
    return ", ".join(f"({_LIT(r.name)}, {_LIT(r.verdict)}, {_LIT(r.pattern)})" for r in rules)


URL_SQL = f"""
WITH p AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '{url_filter.HOST}', 1), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(url, '{url_filter.PATH}', 1), '') AS path FROM pages),
h AS (SELECT DISTINCT ON (u) host || path AS u, name, verdict FROM (SELECT DISTINCT host, path FROM p),
      (VALUES {_rules_sql(url_filter.HOST_RULES)}) r(name, verdict, pattern)
      WHERE regexp_matches(host || path, pattern) ORDER BY u, length(name) DESC, name),
g AS (SELECT DISTINCT ON (url) url, name, verdict FROM (SELECT DISTINCT url FROM p),
      (VALUES {_rules_sql(url_filter.PATTERN_RULES)}) r(name, verdict, pattern)
      WHERE regexp_matches(url, pattern) ORDER BY url, length(name) DESC, name)
SELECT page_id, host, path, h.name AS rule,
       CASE WHEN url IS NULL OR NOT contains(url, '://') THEN 'block'
            ELSE coalesce(h.verdict, g.verdict, 'allow') END AS verdict,
       CASE WHEN h.name IS NULL THEN g.name END AS pattern
FROM p LEFT JOIN h ON h.u = host || path LEFT JOIN g USING (url)"""

LINE_SQL = f"""
WITH u AS (SELECT doc_id, source, md5(text) AS page, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
l AS (SELECT *, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS bare FROM u),
total AS (SELECT source, count(DISTINCT md5(text)) AS total FROM documents WHERE text IS NOT NULL GROUP BY source),
bad AS (SELECT l.source, bare, true AS bad FROM l JOIN total t ON l.source IS NOT DISTINCT FROM t.source
        WHERE bare <> '' GROUP BY l.source, bare, total
        HAVING count(DISTINCT page) >= {line_dedup.MIN_PAGES} AND count(DISTINCT page) > total * {line_dedup.RATIO})
SELECT doc_id, count(*) AS n_lines, count(bad) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (bad IS NULL), '') AS text
FROM l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.bare = b.bare
GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL"""

LEAK_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, least(len(ws), {decontamination.SIZE}) AS k,
             array_to_string(ws[i:i + least(len(ws), {decontamination.SIZE}) - 1], ' ') AS g
      FROM b, unnest(range(1, greatest(len(ws) - {decontamination.SIZE - 1}, 1) + 1)) AS t(i) WHERE len(ws) > 0),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g
       FROM d, (SELECT DISTINCT k FROM w), unnest(range(1, greatest(len(ws) - k + 2, 1))) AS t(i)),
hits AS (SELECT doc_id, item_id, i, k FROM dw JOIN w USING (k, g)),
per_item AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
             FROM hits GROUP BY doc_id),
per_word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN per_item USING (doc_id) LEFT JOIN per_word USING (doc_id)"""

ORACLE_SQL = {
    "op12_decontamination": LEAK_SQL,
    "op3_quality_rules": QUALITY_SQL,
    "op8_url_filters": URL_SQL,
    "op9_line_dedup": LINE_SQL,
}
