"""Site-relative line dedup (native): drop the lines that stand on too large a
share of a host's pages.

A page is a distinct text of a host, so whole copies of one page do not make
its lines boilerplate.  Lines are compared without white space at their ends.
A line goes if it is on ``min_pages`` pages of the host at least and on more
than ``ratio`` of them.

Only (host, line digest, page digest) rows are shuffled, never text, and they
are combined before the shuffle.  A host has at most (lines per page) / ratio
lines above the ratio, so its list is bounded; the lists are broadcast if there
are few lines in all (counted) and otherwise joined by host, with each list
written ``SALTS`` times so that a hot host's pages spread over as many tasks.

Defined results: a null text stays null and counts as no page; lines without a
word are never dropped nor counted; a null host is a host of its own; repeated
rows count once and are cleaned each; an empty table gives an empty result;
further columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .quality_rules import with_text
from .words import WHITE_SPACE, is_blank, lines

RATIO = 0.02
MIN_PAGES = 3
MAX_BROADCAST_LINES = 200_000
SALTS = 64


def digest(line: Column) -> Column:
    """128 bits of a line as a pair of longs."""
    bare = F.btrim(line, F.lit(WHITE_SPACE))
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line) of the lines above the ratio, line as ``digest``."""
    pages = (docs.select(F.col(host).alias("host"), F.col("text").alias("t")).where("t is not null")
             .select("host", F.xxhash64("t").alias("p"), F.xxhash64(F.lit(1), "t").alias("q"),
                     lines(F.col("t")).alias("ls")))
    found = (pages.select("host", "p", "q", F.explode(F.array_distinct(F.transform(
        F.filter("ls", lambda s: ~is_blank(s)), digest))).alias("line")).distinct()
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages))
    totals = (pages.select("host", "p", "q").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("total")))
    return (found.join(totals.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
            .where(F.col("n") > F.col("total") * ratio).select("host", "line"))


def _marked(docs: DataFrame, host: str, ratio: float, min_pages: int, max_broadcast: int) -> DataFrame:
    """``doc`` with its lines ``ls`` and those that stay, ``left``."""
    bad = materialize(boilerplate(docs, host, ratio, min_pages), "boilerplate-lines")
    lists = bad.groupBy(F.col("host").alias("h")).agg(F.collect_set("line").alias("drop"))
    rows = docs.select(F.struct("*").alias("doc"))
    same = F.col(f"doc.{host}").eqNullSafe(F.col("h"))
    if bad.count() <= max_broadcast:
        joined = rows.join(F.broadcast(lists), same, "left")
    else:
        salted = lists.select("h", "drop", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        joined = rows.join(salted, same & (F.pmod(F.xxhash64("doc.text"), F.lit(SALTS)) == F.col("salt")), "left")
    split = joined.select("doc", "drop", lines(F.col("doc.text")).alias("ls"))
    left = F.when(F.col("drop").isNull(), F.col("ls")).otherwise(
        F.filter("ls", lambda s: is_blank(s) | ~F.array_contains(F.col("drop"), digest(s))))
    return split.select("doc", "ls", left.alias("left"))


def without_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
                        max_broadcast: int = MAX_BROADCAST_LINES) -> DataFrame:
    """The documents with the boilerplate lines of their host dropped."""
    marked = _marked(docs, host, ratio, min_pages, max_broadcast)
    text = F.when(F.size("left") < F.size("ls"), F.array_join("left", "\n")).otherwise(F.col("doc.text"))
    return marked.select("doc", text.alias("new_text")).select(*with_text(docs, F.col("new_text")))


def report(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
           max_broadcast: int = MAX_BROADCAST_LINES) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is left."""
    marked = _marked(docs, host, ratio, min_pages, max_broadcast)
    return marked.select(F.col("doc.doc_id").alias("doc_id"), F.size("ls").cast("bigint").alias("n_lines"),
                         (F.size("ls") - F.size("left")).cast("bigint").alias("n_dropped"),
                         F.when(F.size("left") < F.size("ls"), F.array_join("left", "\n"))
                         .otherwise(F.col("doc.text")).alias("text"))
