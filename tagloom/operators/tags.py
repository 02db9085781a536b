"""Tag analysis: tokenise raw tag lines, remove stop words, count and rank.

Plan shape (one Catalyst plan per output):

    lines -> dealt out evenly -> tokens of each line, in place
          -> stop words -> distinct (image, token)

Both shuffles have a width that grows with the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import tag_words as W
from ..functions import text as X
from ..session import ship_package, spread

LINE_BREAK = "\\r\\n|\\r|\\n"


def lines_from_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line of a text column -> (image, label), like a text scan.
    One kind of line break is made first: splitting at a single character needs
    no regular expression."""
    one_kind = F.replace(F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return df.select(F.col(key).alias("image"), F.explode(F.split(one_kind, "\n")).alias("label"))


# Characters of tag lines in a partition, about.
PARTITION_CHARACTERS = 1 << 23


def partitions_for(lines: DataFrame) -> int:
    """Partitions for the lines or their tokens: with more lines there are more,
    so that no task's share grows."""
    return -(-(lines.agg(F.sum(F.length("label"))).first()[0] or 0) // PARTITION_CHARACTERS)


def line_tokens(label: Column) -> Column:
    """``functions.text.line_tokens``, by tasks that look up each distinct part of their
    lines once; a line with an unsettled character takes the expressions."""
    ship_package(SparkSession.active())
    known = F.arrow_udf(W.tokens_of_lines, "array<string>")
    return F.coalesce(known(label), X.line_tokens(label))


def line_words(label: Column) -> Column:
    """The words after one step, joined by spaces, in the same two ways."""
    ship_package(SparkSession.active())
    known = F.arrow_udf(W.words_of_lines, "string")
    return F.coalesce(known(label), F.array_join(X.rewrite_split(X.singular(X.fold(label))), " "))


def tokenize_lines(lines: DataFrame, partitions: int = 1) -> DataFrame:
    """(image, label) tag lines -> (image, token), each once per line, before
    stop words.  The lines are dealt out evenly first, as the work on one costs
    many times what moving it does.

    ``explode_outer``: a plain ``explode`` would make Spark test the size of the
    tokens before, and so compute them twice.  They are a column first, as an
    ``explode`` of the expressions themselves is not compiled, for any token."""
    return (spread(lines, "image", "label", at_least=partitions)
            .select("image", line_tokens(F.col("label")).alias("tokens"))
            .select("image", F.explode_outer("tokens").alias("token"))
            .where("token is not null"))


def distinct_tokens(lines: DataFrame, stop_words: bool = True) -> DataFrame:
    """Distinct (image, token), with or without the stop words.  The width of the
    shuffle is chosen here; ``distinct`` needs no other one after it."""
    n = partitions_for(lines)
    tokens = tokenize_lines(lines, n)
    kept = tokens if stop_words else tokens.where(X.not_stop_word(F.col("token")))
    return spread(kept, "image", "token", at_least=n).distinct()


def normalized_tags(lines: DataFrame) -> DataFrame:
    """Distinct (image, label_normalized) after stop-word removal."""
    return distinct_tokens(lines, stop_words=False).withColumnRenamed("token", "label_normalized")


def image_tags(lines: DataFrame) -> DataFrame:
    """(image, labels): the sorted ``normalized_tags`` of every image that has any.
    The tokens of a line move as one array, and no (image, token) rows are shuffled
    or stored; an image's set holds each token once, however many lines it has."""
    n = partitions_for(lines)
    tokens = spread(lines, "image", "label", at_least=n).select("image", line_tokens(F.col("label")).alias("tokens"))
    met = (spread(tokens, "image", at_least=n).select("image", F.explode_outer("tokens").alias("token"))
           .where(F.col("token").isNotNull() & X.not_stop_word(F.col("token"))))
    return met.groupBy("image").agg(F.array_sort(F.collect_set("token")).alias("labels"))


def tag_counts(tags: DataFrame) -> DataFrame:
    """Images per normalised tag (label_normalized, tag_count)."""
    return tags.groupBy("label_normalized").agg(F.count(F.lit(1)).alias("tag_count"))


def top_tags(counts: DataFrame, label: str = "label_normalized", count: str = "tag_count",
             n: int = C.TOP_TAGS, prefilter: int = C.TOP_TAGS_PREFILTER,
             exclude: list[str] | None = C.NON_SIGNIFICANT_TAGS) -> DataFrame:
    """Most common ``prefilter`` rows, minus excluded labels, first ``n`` of
    those, sorted by label.  Ties on the count are broken by label."""
    ranked = counts.orderBy(F.desc(count), F.asc(label)).limit(prefilter)
    if exclude:
        ranked = ranked.where(~F.col(label).isin(exclude))
    return ranked.orderBy(F.desc(count), F.asc(label)).limit(n).orderBy(label)


def tags_per_image(tags: DataFrame) -> DataFrame:
    """(image, n_tags, tags) with the tags sorted and joined by spaces."""
    return (tags.groupBy("image")
            .agg(F.count(F.lit(1)).alias("n_tags"),
                 F.array_join(F.array_sort(F.collect_list("label_normalized")), " ").alias("tags")))


def original_tags(lines: DataFrame) -> DataFrame:
    """(id, label) raw tag lines sorted by id (range-partitioned sort)."""
    return lines.select(F.col("image").cast("bigint").alias("id"), "label").orderBy("id")


def most_frequent(counts: DataFrame, label: str, count: str) -> DataFrame:
    """Top-1 row by count (ties: smallest label)."""
    return counts.orderBy(F.desc(count), F.asc(label)).limit(1)


def rescaled_counts(counts: DataFrame, count: str, out: str = "size") -> DataFrame:
    """Adds the count rescaled linearly onto [12, 100] using the global min/max.

    The min/max come from a one-row aggregate joined back by broadcast (a
    single-row table), not from an unpartitioned window."""
    bounds = counts.agg(F.min(count).alias("_lo"), F.max(count).alias("_hi")).withColumn("_k", F.lit(0))
    return (counts.withColumn("_k", F.lit(0)).join(F.broadcast(bounds), "_k")
            .withColumn(out, X.rescale(F.col(count), F.col("_lo"), F.col("_hi")))
            .drop("_lo", "_hi", "_k"))
