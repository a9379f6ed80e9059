"""Small file operations on whatever store a path names, through the session's Hadoop configuration."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, store = _at(spark, path)
    return store.exists(found)


def is_file(spark: SparkSession, path: str) -> bool:
    found, store = _at(spark, path)
    return store.exists(found) and store.getFileStatus(found).isFile()


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or folder; one that is not there is fine."""
    found, store = _at(spark, path)
    store.delete(found, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern with ``*`` matches, none if its folder is missing."""
    found, store = _at(spark, pattern)
    return [status.getPath().toString() for status in store.globStatus(found) or []]


def sizes(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """The paths that a pattern matches, in order, with the bytes of each and of all that lies below."""
    found, store = _at(spark, pattern)
    paths = [status.getPath() for status in store.globStatus(found) or []]
    return sorted((p.toString(), store.getContentSummary(p).getLength()) for p in paths)


def read_text(spark: SparkSession, path: str) -> str:
    found, store = _at(spark, path)
    stream = store.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that appears at once and whole; False, and nothing written, if there is one."""
    found, store = _at(spark, path)
    beside, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = store.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not store.exists(found) and store.rename(beside, found):
        return True
    store.delete(beside, False)
    return False
