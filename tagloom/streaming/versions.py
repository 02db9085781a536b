"""Small tables that a stream republishes: one sub-folder ``batch_id=N`` per
trigger.  A version is seen once its ``_SUCCESS`` is there, so readers never see
part of one; a trigger that runs again after a failure writes its own version
anew.  Old versions go when a new one is whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEEP = 3
_PREFIX = "batch_id="


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, table_dir: str) -> list[int]:
    """Numbers of the whole versions, oldest first (as many as are kept)."""
    fs, folder = _folder(spark, table_dir)
    if not fs.exists(folder):
        return []
    jvm, out = spark._jvm, []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(_PREFIX) and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            out.append(int(name[len(_PREFIX):]))
    return sorted(out)


def version_path(table_dir: str, number: int) -> str:
    return f"{table_dir.rstrip('/')}/{_PREFIX}{number}"


def publish(table: DataFrame, table_dir: str, batch_id: int, keep: int = KEEP, files: int = 1) -> None:
    """Writes a version in ``files`` files and drops all but the last ``keep``."""
    spark = table.sparkSession
    table.repartition(files).write.mode("overwrite").parquet(version_path(table_dir, batch_id))
    for number in versions(spark, table_dir)[:-keep]:
        fs, old = _folder(spark, version_path(table_dir, number))
        fs.delete(old, True)


def read_version(spark: SparkSession, table_dir: str, schema: T.StructType | str, before: int | None = None) -> DataFrame:
    """The newest whole version (older than ``before``), empty if there is none."""
    known = [n for n in versions(spark, table_dir) if before is None or n < before]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(table_dir, known[-1]))
