"""Small files on any filesystem that Spark can write, through Hadoop's API.

Used by the driver for a store's log and for named result files; data itself is
read and written by Spark.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession


class FileInfo(NamedTuple):
    """A file as it stood: qualified path, bytes, time of the last change (ms)."""

    path: str
    bytes: int | None = None
    modified: int | None = None


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def qualified(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    return fs.makeQualified(where).toString()


def from_uri(spark: SparkSession, uri: str) -> str:
    """The path of an escaped URI (as Spark's file metadata has it), written as ``qualified`` writes it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def info(spark: SparkSession, path: str) -> FileInfo | None:
    """What is at a path now, or ``None``."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    status = fs.getFileStatus(where)
    return FileInfo(status.getPath().toString(), status.getLen(), status.getModificationTime())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it doesn't exist."""
    fs, where = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _rename(spark: SparkSession, source: str, target: str, overwrite: bool) -> None:
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if overwrite else kind.NONE
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        path(qualified(spark, source)).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(path(source), path(target), how)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another one (atomic where the filesystem's rename is)."""
    _rename(spark, source, target, overwrite=True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole new file; ``False``, and nothing written, if the path is taken.

    The text is written beside it and renamed, so no reader sees half of it,
    and of two writers of one path one is refused (on filesystems whose rename
    is atomic, as for streaming checkpoints).
    """
    folder, _, name = path.rpartition("/")
    beside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    fs, where = _fs(spark, beside)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if not exists(spark, path):
            _rename(spark, beside, path, overwrite=False)
            return True
    except Exception:
        if not exists(spark, path):
            raise
    finally:
        if fs.exists(where):
            fs.delete(where, False)
    return False


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    if fs.exists(where):
        fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.mkdirs(where)
