"""Token counts through a digest cache.

Counts are stored by (content digest, tokenizer-version digest).  The digests
of the documents are joined with the cache; of the digests that miss, one
document each is encoded, and the new counts are appended to the cache, from
which the result is joined.  So a text is encoded once, however many documents
or later runs have it.

Only digests are grouped (combined before the shuffle), so a text that a third
of all rows share is no hot group; the texts that miss cross one shuffle, by
document id, compressed more tightly than Spark compresses its shuffles.  Where
they are few (``MAX_BROADCAST``, counted) their digests are broadcast instead, and
no text that the cache knows leaves its scan.  The last join is by digest; Spark
splits a skewed digest.

Normalised content is the text with null as the empty text: any other change
(case, white space, Unicode form) would change counts.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
get a row each; null ids are kept; an empty table gives an empty result;
further columns are not read.  A cache that does not exist yet is empty; rows
that two runs append twice are harmless.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .tokenizing import read_definition, token_counter

LIMIT = 512
MAX_BROADCAST = 100_000
CACHE_SCHEMA = "digest binary, version string, n_tokens long"


def stored(spark: SparkSession, cache: str) -> DataFrame:
    """The cache, empty if there is none at the path."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def _compress(batches):
    for batch in batches:
        raw = [t.encode() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(map(len, raw), pa.int64()),
             pa.array([pa.compress(t, codec="zstd", asbytes=True) if t else b"" for t in raw], pa.binary())],
            names=["doc_id", "digest", "n_bytes", "packed"])


def _encode(definition: str):
    def encode(batches):
        counter = token_counter(definition.value)
        for batch in batches:
            texts = (pa.decompress(z, n, codec="zstd", asbytes=True).decode() if n else ""
                     for z, n in zip(batch.column("packed").to_pylist(), batch.column("n_bytes").to_pylist()))
            counts = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())],
                                             names=["digest", "n_tokens"])
    return encode


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = LIMIT, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; appends the
    counts that the cache at ``cache`` lacks.  ``tokenizer``: path of the file."""
    spark = docs.sparkSession
    ship_package(spark)
    definition = read_definition(tokenizer)
    version = hashlib.sha256(definition.encode()).hexdigest()
    content = F.coalesce(F.col("text"), F.lit(""))
    full = docs.select("doc_id", content.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    keyed = materialize(full.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")), "digests")
    known = stored(spark, cache).where(F.col("version") == version).select("digest")
    misses = materialize(keyed.groupBy("digest").agg(F.min("doc_id").alias("one")).join(known, "digest", "left_anti")
                         .withColumnRenamed("digest", "miss"), "missed-digests")
    n_misses = misses.count()
    if n_misses:
        kind = docs.schema["doc_id"].dataType.simpleString()
        wanted = F.col("doc_id").eqNullSafe(F.col("one")) & (F.col("digest") == F.col("miss"))
        rows = "doc_id {}, digest binary, n_bytes long, packed binary".format(kind)
        if n_misses <= max_broadcast:
            # Few texts are new: only they leave the scan.
            texts = full.join(F.broadcast(misses), wanted, "left_semi").mapInArrow(_compress, rows)
            texts = texts.repartition("digest")
        else:
            # The side of the misses has small rows and is the one that is hashed.
            texts = full.mapInArrow(_compress, rows).join(misses.hint("shuffle_hash"), wanted)
        shared = spark.sparkContext.broadcast(definition)
        new = texts.select("digest", "n_bytes", "packed").mapInArrow(_encode(shared), "digest binary, n_tokens long")
        (new.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache))
    counts = (stored(spark, cache).where(F.col("version") == version)
              .groupBy("digest").agg(F.first("n_tokens").alias("n_tokens")))
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
