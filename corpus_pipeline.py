"""Corpus pipeline: clean the documents, drop boilerplate and near-duplicates,
mix the sources and pack what is left into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again for the next one.  All but the last return
the columns of ``documents``.  An empty corpus gives an empty result; null and
blank texts are rejected by the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from tagloom.llm.queries import tokenizer_file
from tagloom.session import scratch_path
from tagloom.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and documents that are rejected."""
    return quality_rules.cleaned(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go."""
    return line_dedup.without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dedup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, copies included, in pieces of training sequences."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"), with_ids=True)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("mixing", mix),
          ("packing", pack)]
# Hash draws, fitted rates, signatures and tokens are beyond SQL; the tests hold
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``; the last one is returned as it is."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
