"""Stored models: fitted once for a version of their training data, then loaded.

A model is a table in ``<folder>/<name>/<version>``; the version is a digest of
the training files (path, length, time of change) and of the parameters, or one
that the caller gives.  It is written beside its place and moved there when it
is whole, so a reader never sees part of a model, and of two writers one wins.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def training_version(training: DataFrame, *parameters) -> str:
    """Digest of the files that ``training`` is read from (its rows are not
    read) and of the parameters."""
    files = training.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    parts = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("*").cast("decimal(38,0)")).alias("s")).first()
    return hashlib.sha256(repr((parts["n"], str(parts["s"]), parameters)).encode()).hexdigest()[:20]


def default_folder(spark: SparkSession) -> str:
    return checkpoint_dir(spark).rstrip("/") + "/tagloom-models"


def stored(spark: SparkSession, name: str, version: str, fit: Callable[[], DataFrame], folder: str | None = None) -> DataFrame:
    """The model ``name`` of this version; ``fit`` is called if there is none."""
    place = f"{(folder or default_folder(spark)).rstrip('/')}/{name}/{version}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(place)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        beside = f"{place}-{uuid.uuid4().hex[:12]}"
        fit().write.parquet(beside)
        if fs.exists(target) or not fs.rename(path(beside), target):
            fs.delete(path(beside), True)
    return spark.read.parquet(place)
