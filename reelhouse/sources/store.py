"""Small files of a table's bookkeeping, in any file system that Spark reads."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    """The path, and the file system that it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, in order; none if there is no such folder."""
    files, where = _opened(spark, folder)
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where))


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _opened(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def total_bytes(spark: SparkSession, folder: str) -> int:
    files, where = _opened(spark, folder)
    return files.getContentSummary(where).getLength()


def delete(spark: SparkSession, path: str) -> None:
    files, where = _opened(spark, path)
    files.delete(where, True)


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must be new; False if its name is taken already.

    The text is written under a hidden name and then given its own in one step, so readers see
    all of it or nothing, and of several writers exactly one succeeds. That step is a hard link in
    local folders and a rename elsewhere, which refuses a taken name in HDFS and in the stores that
    follow it. An object store without such a rename is no place for a table that has several
    writers.
    """
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    files, where = _opened(spark, folder)
    files.mkdirs(where)
    if files.getUri().getScheme() == "file":
        local = _local(hidden)
        with open(local, "x", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(local, _local(path))
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
        return True
    stream = files.create(_opened(spark, hidden)[1], False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    try:
        if files.rename(_opened(spark, hidden)[1], _opened(spark, path)[1]):
            return True
    except PySparkException:
        if not files.exists(_opened(spark, path)[1]):
            raise
    files.delete(_opened(spark, hidden)[1], False)
    return False


def _local(path: str) -> str:
    parsed = urlparse(path)
    return unquote(parsed.path) if parsed.scheme == "file" else path
