"""Small file-system chores through Spark's own file-system layer, so the same code runs on
local paths and on a cluster's shared store."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of everything below a directory; 0 where there is nothing."""
    if not exists(spark, path):
        return 0
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Move a file or directory, replacing an older one."""
    fs = _fs(spark, dst)
    fs.mkdirs(_path(spark, dst).getParent())
    if fs.exists(_path(spark, dst)):
        fs.delete(_path(spark, dst), True)
    if not fs.rename(_path(spark, src), _path(spark, dst)):
        raise OSError(f"could not move {src} to {dst}")


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a marker or pointer file: written aside, then renamed over the old one."""
    jvm = spark._jvm
    aside = f"{path}.{uuid.uuid4().hex}"
    out = _fs(spark, path).create(_path(spark, aside), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(_path(spark, aside), _path(spark, path), options)


def set_modified(spark: SparkSession, path: str, seconds: int) -> None:
    """Give a file the modification time of its source, as a copy that keeps times does."""
    _fs(spark, path).setTimes(_path(spark, path), seconds * 1000, -1)


def read_small(spark: SparkSession, path: str) -> str:
    """Text of a marker or pointer file."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Files below a root as ``path, length, modified``; contents are not read.

    Spark's readers pass over empty files, so those are added from the reader's own index of
    the directory: file names, which the driver holds for any scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(root)
    listing = found.select("path", "length", F.col("modificationTime").alias("modified"))
    names = found.inputFiles()
    if len(names) == listing.count():
        return listing
    indexed = spark.createDataFrame([(name,) for name in names], "value string")
    decoded = F.url_decode(F.replace("value", F.lit("+"), F.lit("%2B")))
    plain = F.regexp_replace(decoded, "^file:/+", "file:/")
    unread = indexed.select(plain.alias("path")).join(listing.select("path"), "path", "left_anti")
    empty = []
    for row in unread.toLocalIterator():  # only empty files come this far
        status = _fs(spark, row.path).getFileStatus(_path(spark, row.path))
        if status.getLen() == 0:
            empty.append((row.path, 0, datetime.fromtimestamp(status.getModificationTime() / 1000)))
    if not empty:
        return listing
    return listing.unionByName(spark.createDataFrame(empty, listing.schema))


def list_entries(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """Entries directly below each root as ``root, path, length, modified``.

    One file-system call per root; the entries are day directories and the like.
    """
    rows = []
    for root in roots:
        for s in _fs(spark, root).listStatus(_path(spark, root)):
            at = datetime.fromtimestamp(s.getModificationTime() / 1000)
            rows.append((root, s.getPath().toString(), s.getLen(), at))
    return spark.createDataFrame(rows, "root string, path string, length long, modified timestamp")


def shared_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh directory every executor can reach, below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="granary-")
    return f"{base.rstrip('/')}/granary/{name}-{uuid.uuid4().hex}"
