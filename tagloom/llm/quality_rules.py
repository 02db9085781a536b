"""Line-first quality cleaning (native expressions only, no shuffle).

Every line that has a word is judged by three rules; lines that fail are
removed; a document that loses too large a share of its words is rejected.

* punctuation: marks of ``[!?*#$%&<>]`` per word reach ``MARKS_PER_WORD``
  (shouting and symbol noise), or the line has ``LONG_LINE`` words or more and
  not one of ``.,;:!?`` (word lists)
* navigation: separators (words that are only ``| > / - » › · •``) make up
  ``SEPARATOR_SHARE`` of the words and there are at least two (menus, crumbs,
  table rows)
* boilerplate: the line has one of ``BOILERPLATE`` and at most
  ``BOILERPLATE_WORDS`` words

The base measures count over the whole text: words, code points in words,
symbols, repeated lines and words covered by repeated 8-word windows.  The
windows are compared by 64-bit hash inside the row, so nothing is shuffled
however often a window repeats; a row costs O(n log n) in its words.

Defined results: a null or blank text has no word, so it fails the base test
(fewer than ``MIN_WORDS`` words); lines without a word are kept as they are and
never count as repeated; repeated rows are judged one by one; an empty table
gives an empty result; columns other than ``text`` pass through untouched,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import lines, words

# Fixed values of the rules.
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MARKS = r"[!?*#$%&<>]"
MARKS_PER_WORD = 0.5
LONG_LINE = 30
SENTENCE_MARKS = "[.,;:!?]"
SEPARATOR_WORD = r"(?<![^\x20\x09-\x0D])[|>/»›·•-]+(?![^\x20\x09-\x0D])"
SEPARATOR_SHARE = 0.2
BOILERPLATE = ("all rights reserved|licensed under|is licensed|terms of (use|service)|privacy policy|"
               "cookie policy|accept cookies|released under the|powered by|copyright|©|javascript is disabled|"
               "sign in|log in|subscribe to")
BOILERPLATE_WORDS = 25
MAX_LOST = 0.3


def bad_line(line: Column, n: Column) -> Column:
    """True if a line of ``n`` > 0 words fails one of the three rules."""
    marks = F.regexp_count(line, F.lit(MARKS))
    separators = F.regexp_count(line, F.lit(SEPARATOR_WORD))
    punctuation = (marks >= n * MARKS_PER_WORD) | ((n >= LONG_LINE) & ~line.rlike(SENTENCE_MARKS))
    navigation = (separators >= 2) & (separators >= n * SEPARATOR_SHARE)
    boilerplate = (n <= BOILERPLATE_WORDS) & F.lower(line).rlike(BOILERPLATE)
    return (n > 0) & (punctuation | navigation | boilerplate)


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more, given the
    hash of the window at each position."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = F.transform(F.array(pairs), lambda s: F.filter(s, lambda x, j:
                        ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | (F.get(s, j + 1)["h"] == x["h"])))[0]
    starts = F.sort_array(F.transform(again, lambda x: x["i"]))
    covered = F.transform(F.array(starts), lambda s: F.aggregate(
        s, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last"))))[0]
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered["n"]).otherwise(F.lit(0)).cast("bigint")


def measured(docs: DataFrame) -> DataFrame:
    """``doc`` (the row as it came) and its measures, verdict and kept lines."""
    text = F.col("doc.text")
    split = (docs.select(F.struct("*").alias("doc")).select("doc", lines(text).alias("ls"))
             .select("doc", "ls", F.transform("ls", words).alias("lw"))
             .select("doc", "ls", F.transform("lw", F.size).alias("line_words"), F.flatten("lw").alias("w")))
    hashed = split.select(
        "doc", "ls", "line_words", F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.when(F.size("w") >= WINDOW,
               F.transform(F.sequence(F.lit(1), F.size("w") - WINDOW + 1),
                           lambda i: F.xxhash64(F.slice(F.col("w"), i, F.lit(WINDOW)))))
        .otherwise(F.array().cast("array<bigint>")).alias("hashes"),
        F.filter("ls", lambda s, i: F.get("line_words", i) > 0).alias("full"))
    judged = hashed.select(
        "doc", "n_words", "word_chars",
        F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("bigint").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("hashes")).alias("n_repeat_words"),
        F.zip_with("ls", "line_words", lambda s, n: F.struct(s.alias("s"), n.alias("n"),
                                                           bad_line(s, n).alias("bad"))).alias("js"))
    counted = judged.withColumn("lost_words", F.aggregate(
        "js", F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["bad"], x["n"]).otherwise(0)))
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (counted.withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= F.col("n_words") * MAX_LOST)))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: its id, the base measures and the verdict."""
    return measured(docs).select(F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols",
                                 "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words")


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents that pass, without their failed lines, columns as given
    (``n_chars``, if there, is counted anew where the text changed)."""
    text = F.array_join(F.transform(F.filter("js", lambda x: ~x["bad"]), lambda x: x["s"]), "\n")
    new = F.struct("doc", F.when(F.col("lost_words") > 0, text).otherwise(F.col("doc.text")).alias("new_text"))
    # A filter on the verdict would be pushed below the measures, with a copy of
    # them; one on the output of a generator stays where it is.
    kept = measured(docs).select(F.explode_outer(F.array_repeat(new, F.col("kept").cast("int"))).alias("k"))
    return kept.where("k is not null").select("k.*").select(*with_text(docs, F.col("new_text")))


def with_text(docs: DataFrame, text: Column) -> list[Column]:
    """The columns of ``docs`` out of the struct ``doc``, with a new ``text``
    and, where the table counts them, new ``n_chars``."""
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)
           if "n_chars" in docs.columns else None}
    return [(new[c] if new.get(c) is not None else F.col("doc").getField(c)).alias(c) for c in docs.columns]
