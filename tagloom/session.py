"""Spark session and checkpoint-folder helpers.

Cluster settings win: nothing here overrides a value that was submitted or that
a running session has.  The checkpoint folder is read from
``spark.checkpoint.dir``; a private folder is made only for a local session
without the setting, and without it a cluster session is refused.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A checkpoint goes when nothing in the driver refers to it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tagloom") -> SparkSession:
    """A session with the defaults above wherever neither the submitted
    configuration nor a running session has set a value."""
    running = SparkSession.getActiveSession()
    if running is not None:
        checkpoint_dir(running)
        return running
    wanted = dict(_DEFAULTS)
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if os.environ.get("TAGLOOM_DRIVER_MEMORY") or master:
        wanted["spark.driver.memory"] = os.environ.get("TAGLOOM_DRIVER_MEMORY", "16g")
    if master:
        wanted["spark.master"] = master
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # started by spark-submit: read what it was given
        SparkContext._ensure_initialized()
    submitted = SparkConf()
    arguments = os.environ.get("PYSPARK_SUBMIT_ARGS", "").replace("--driver-memory", "spark.driver.memory")
    builder = SparkSession.builder.appName(app_name)
    for key, value in wanted.items():
        if not submitted.contains(key) and key not in arguments:
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    On a cluster it has to be set, as executors cannot see a folder of the
    driver; a local session gets a private one, removed when Python ends."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tagloom-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (for written tables).
    It stays until ``drop_scratch``, as the caller's result may read from it."""
    base = checkpoint_dir(spark).rstrip("/")
    _scratch.append(f"{base}/tagloom-{name}-{uuid.uuid4().hex[:12]}")
    return _scratch[-1]


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the scratch folders that this process has made so far; to be called
    when the results of its queries are written.  Stored models and caches stay."""
    n = 0
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application (they
    need not have it installed, nor share a folder with the driver)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tagloom-code-"), "tagloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def materialize(df, name: str):
    """Compute ``df`` once and cut its lineage with a reliable checkpoint into
    the shared checkpoint folder (never ``localCheckpoint``): later stages and
    every branch that reads it start from the stored partitions, and a lost
    executor does not force recomputation of the upstream plan.  ``name``
    labels the intent in code; Spark names the files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df, *keys: str, at_least: int = 1):
    """Deal the rows out evenly before CPU-heavy per-row work (regex chains,
    trigram extraction), by a hash of ``keys``, which should be nearly unique,
    or in turn.  Width: the session's shuffle partitions (at least the default
    parallelism), or ``at_least`` partitions if they are more."""
    spark = df.sparkSession
    n = max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)
