"""Writers of the reference's output datasets.

All writes overwrite the target only (never a parent folder).  ``files`` sets
the number of output files: the rows are dealt to that many tasks by one shuffle,
so the work before it keeps its own number of tasks.  ``order`` sorts them: by
range over the files and within each, so the files in the order of their names
hold the rows in order.
"""

from __future__ import annotations

import os
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package


def arranged(df: DataFrame, files: int | None = None, order: list[str] | None = None) -> DataFrame:
    """``df`` in ``files`` partitions, in global order if ``order`` is given.

    A value that many rows share may span files: its rows are told apart by a
    hash of the row, and only the columns of ``order`` have to be in order."""
    if order and files:
        last = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        return df.repartitionByRange(files, *[F.col(c) for c in order], last).sortWithinPartitions(*order)
    if order:
        return df.orderBy(*order)
    return df.repartition(files) if files else df


def write_text(df: DataFrame, path: str, files: int | None = None, order: list[str] | None = None) -> None:
    """One STRING column, one value per line."""
    arranged(df, files, order).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str, files: int | None = None, order: list[str] | None = None) -> None:
    arranged(df, files, order).write.mode("overwrite").json(path)


def write_delimited(df: DataFrame, path: str, sep: str, files: int | None = None, order: list[str] | None = None) -> None:
    """Header-less CSV with the given separator (``~`` label counts, ``,`` languages)."""
    arranged(df, files, order).write.mode("overwrite").option("sep", sep).option("header", "false").csv(path)


# The name of the file that holds the rows without a name, as Spark calls their folder.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
# Characters that Spark writes as %XX in the name of a folder.
_ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


# Names that a reader would skip, or take for a part of a folder ``file=<name>``.
_NOT_FLAT = re.compile(r"[._]|part-")


def write_named_texts(df: DataFrame, path: str, name: str, value: str, folders: bool = True) -> None:
    """One text file per ``name``: ``path/file=<name>/part-*``, one line a row.
    The rows of a name meet in one task, as they are one file.

    On a shared folder of the machines each task creates its files itself: Spark's
    writer adds a checksum file to each, starts a process for the mode of both if
    Hadoop's native library is missing, and moves all files in the driver at the
    end.  Any other store is left to Spark's writer.  Without ``folders`` a task puts
    its files side by side into one folder, ``path/<task>/<name>``: a folder for each
    file takes as much disk as a short file."""
    rows = df.select(F.col(name).alias("file"), F.col(value).alias("value"))
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() != "file":
        rows.repartition("file").sortWithinPartitions("file").write.mode("overwrite").partitionBy("file").text(path)
        return
    store.delete(target, True)
    store.mkdirs(target)
    ship_package(spark)
    packed = rows.select("file", F.col("value").cast("binary").alias("value")).mapInArrow(_packed, "file string, lines binary")
    packed = packed.repartition("file").sortWithinPartitions("file")
    packed.mapInArrow(_files_of_task(target.toUri().getPath(), folders), "n long").agg(F.sum("n")).collect()


# Bytes of lines that move as one row, bytes and rows of a batch of those, about.
_PACK, _BATCH, _BATCH_ROWS = 1 << 16, 1 << 22, 10_000


def _packed(batches):
    """Rows (file, value) -> rows (file, compressed lines): neighbours of one file, a
    bounded number of bytes together, so that the shuffle takes less disk than the texts."""
    name, held, size, out, n = None, [], 0, [], 0

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary()))], names=["file", "lines"])

    def row():
        return name, zlib.compress(b"\n".join(held) + b"\n", 1)
    for batch in batches:
        for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
            file, value = file or NO_NAME, value or b""
            if held and (file != name or size + len(value) > _PACK):
                out.append(row())
                n += len(out[-1][1])
                held, size = [], 0
                if n > _BATCH or len(out) >= _BATCH_ROWS:
                    yield batch_of(out)
                    out, n = [], 0
            name, size = file, size + len(value) + 1
            held.append(value)
    if held:
        out.append(row())
    if out:
        yield batch_of(out)


def _files_of_task(root: str, folders: bool = True):
    """Rows sorted by file -> the number of files written.  A file appears under its
    name when it is whole, so a task that runs again does no harm."""
    def write(batches):
        task = TaskContext.get()
        attempt = f".attempt-{task.partitionId():05d}-{task.taskAttemptId()}"
        shared = os.path.join(root, f"{task.partitionId():05d}")
        name, beside, at, out, n = None, None, None, None, 0

        def begun():
            # A file is renamed in its folder if it can be: a move between folders waits for all others.
            safe = _ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", name)
            if folders or _NOT_FLAT.match(safe):
                folder, own, own_root = os.path.join(root, "file=" + safe), f"part-{task.partitionId():05d}.txt", root
            else:
                folder, own, own_root = shared, safe, shared
            os.makedirs(own_root, exist_ok=True)
            beside = os.path.join(own_root, attempt)
            return beside, (folder, own), open(beside, "wb")

        def done():
            out.close()
            os.makedirs(at[0], exist_ok=True)
            os.replace(beside, os.path.join(*at))
        for batch in batches:
            for file, lines in zip(batch.column("file").to_pylist(), batch.column("lines").to_pylist()):
                if file != name:
                    if out:
                        done()
                    name, n = file, n + 1
                    beside, at, out = begun()
                out.write(zlib.decompress(lines))
        if out:
            done()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])
    return write
