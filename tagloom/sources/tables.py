"""Readers for the driver tables and for the reference's file formats."""

from __future__ import annotations

import bz2
import gzip
import os
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..session import ship_package, spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Explicit schemas of the reference's interchange files (never inferred).
SCORE_SCHEMA = T.StructType([
    T.StructField("image", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("score", T.DoubleType()),
])
PAIR_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("label", T.StringType()),
])
LABEL_COUNT_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("count", T.LongType()),
])
LANG_COUNT_SCHEMA = T.StructType([
    T.StructField("idioma", T.StringType()),
    T.StructField("count", T.LongType()),
])
STATS_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("num_images", T.LongType()),
    T.StructField("num_predicciones", T.LongType()),
    T.StructField("aciertos", T.LongType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The part of a path that names the file: the last one, or the folder
# ``file=<name>`` of a file that Spark wrote.
_NAMED = "(?:^|/)(?:file=)?([^/=]*)(?:/part-[^/]*)?$"


def file_name(path) -> F.Column:
    return F.regexp_extract(path, _NAMED, 1)


def _named_files(spark: SparkSession, kind: str, path: str, glob: str | None):
    reader = spark.read.format(kind).option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def read_tag_files(spark: SparkSession, path: str) -> DataFrame:
    """Folder of ``tags<N>.txt`` files, one tag per line -> (image, label).

    A folder that the machines share is listed and read by tasks.  Spark's reader
    lists any other store; it holds an entry of every file in the driver, and packs
    many small files into a task (``spark.sql.files.openCostInBytes``)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    lines = None
    if store.getUri().getScheme() == "file" and store.exists(target) and store.getFileStatus(target).isDirectory():
        lines = _shared_lines(spark, target.toUri().getPath())
    if lines is None:
        lines = _named_files(spark, "text", path, None).select(F.col("_metadata.file_path").alias("path"), "value")
    return lines.select(X.tag_file_key(file_name(F.col("path"))).alias("image"), F.col("value").alias("label"))


# Bytes of a file that one task reads, rows and bytes of a batch.
_PIECE = 1 << 26
_BATCH_ROWS, _BATCH_BYTES = 10_000, 1 << 22
_PACKED = {".gz": gzip.open, ".bz2": bz2.open}
_OTHER_PACKED = r"\.(deflate|lz4|snappy|zst)$"
_MARK = b"\xef\xbb\xbf"


def _shared_lines(spark: SparkSession, root: str) -> DataFrame | None:
    """(path, value): every line below a shared folder, as Spark's text reader gives
    them.  One task lists the folder itself, others what is in its folders, and the
    pieces of the files are dealt out to be read: the driver sees no file.  None if
    some file is packed in a way that only Spark reads."""
    ship_package(spark)
    top = spark.createDataFrame([(root,)], "path string").coalesce(1).mapInArrow(_listed, "path string")
    pieces = spread(top, "path").mapInArrow(_pieces, "path string, start long, stop long")
    if pieces.agg(F.count_if(F.col("path").rlike(_OTHER_PACKED))).first()[0]:
        return None
    lines = spread(pieces, "path", "start").mapInArrow(_lines, "path string, value binary")
    return lines.select("path", F.col("value").cast("string").alias("value"))


def _hidden(name: str) -> bool:
    """What Spark's listing leaves out."""
    if name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _entries(folder: str):
    with os.scandir(folder) as found:
        for entry in found:
            if not _hidden(entry.name):
                yield entry


def _batches(rows, schema: pa.Schema, size=lambda row: 0):
    """Rows in record batches of a bounded number of rows and bytes."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += size(row)
        if len(held) >= _BATCH_ROWS or n >= _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _listed(batches):
    """Folders -> what they hold."""
    folders = (f for batch in batches for f in batch.column("path").to_pylist())
    return _batches(((e.path,) for f in folders for e in _entries(f)), pa.schema([("path", pa.string())]))


def _pieces(batches):
    """Files and folders -> the pieces of all files below them."""
    def below(path):
        if os.path.isdir(path):
            for entry in _entries(path):
                yield from below(entry.path)
            return
        size = os.stat(path).st_size
        step = _PIECE if os.path.splitext(path)[1] not in _PACKED else max(1, size)
        for start in range(0, size, step):
            yield path, start, min(size, start + step)
    paths = (p for batch in batches for p in batch.column("path").to_pylist())
    return _batches((x for p in paths for x in below(p)), pa.schema([("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def _lines(batches):
    """Pieces of files -> (path as a URI, line)."""
    def rows():
        for batch in batches:
            for path, start, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "stop"))):
                uri = "file://" + quote(path, safe="/_-!.~'()*,;:$&+=@")
                for line in _lines_of(path, start, stop):
                    yield uri, line
    return _batches(rows(), pa.schema([("path", pa.string()), ("value", pa.binary())]), lambda row: len(row[0]) + len(row[1]))


def _lines_of(path: str, start: int, stop: int):
    """The lines that begin in ``start``..``stop``, without their ends (CR, LF or both);
    a mark at the file's start is no part of its first line."""
    kind = os.path.splitext(path)[1]
    with _PACKED.get(kind, open)(path, "rb") as f:
        if kind not in _PACKED and not start and stop < _PIECE:
            yield from f.read().removeprefix(_MARK).splitlines()
            return
        # From the byte before: what it belongs to began in the piece before.
        f.seek(max(0, start - 1))
        for at, line in _lines_from(f, max(0, start - 1)):
            if kind not in _PACKED and at >= stop:
                return
            if at >= start:
                yield line


def _lines_from(f, at: int):
    """(offset, line) of what follows in a file at offset ``at``."""
    rest, mark = b"" if at else f.read(len(_MARK)), 0
    if rest == _MARK:
        rest, mark = b"", len(_MARK)
    while True:
        block = f.read(1 << 20)
        lines = (rest + block).splitlines(keepends=True)
        # Unless the file ends, the last line may go on, if only by the LF behind a CR.
        rest = lines.pop() if block and lines and not lines[-1].endswith(b"\n") else b""
        for line in lines:
            yield at, line.removesuffix(b"\n").removesuffix(b"\r") if line.endswith(b"\n") else line.removesuffix(b"\r")
            at, mark = at + mark + len(line), 0
        if not block:
            return


def read_stored_vectors(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """Folder of ``im<N>.*`` files as binaries -> (id, embedding); a file whose
    bytes are no vector (of ``dim`` numbers, if given) has a null one, an empty
    file has no row.

    The stored form is the numbers as text, separated by commas: the stand-in
    for image bytes.  A binary is read whole, as an image is."""
    files = _named_files(spark, "binaryFile", path, None).select("path", "content")
    numbers = F.transform(F.split(F.btrim(F.col("content").cast("string"), F.lit(" \n")), ","), lambda n: n.try_cast("float"))
    whole = F.forall("v", lambda n: n.isNotNull()) & (F.lit(True) if dim is None else F.size("v") == dim)
    return (files.select(X.image_number(X.url_base_name(file_name(F.col("path")))).alias("id"), numbers.alias("v"))
            .select("id", F.when(whole, F.col("v")).alias("embedding")))


def read_language_counts(spark: SparkSession, path: str) -> DataFrame:
    """``language,count`` lines of the language histogram."""
    return read_delimited(spark, path, LANG_COUNT_SCHEMA, ",")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``{image, label, score}`` read by name."""
    return spark.read.schema(SCORE_SCHEMA).json(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``{id, label}``."""
    return spark.read.schema(PAIR_SCHEMA).json(path)


def read_label_list(spark: SparkSession, path: str) -> DataFrame:
    """Text file, one label per line (kept as a DataFrame, never collected)."""
    return spark.read.text(path).select(F.col("value").alias("label")).where(F.length("label") > 0)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    """Header-less delimited file with a fixed schema (``~``, ``|`` or ``,``)."""
    return spark.read.schema(schema).option("sep", sep).option("header", "false").csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a fixed schema; blank lines produce no row."""
    return spark.read.schema(schema).json(path)
