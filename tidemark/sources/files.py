"""File-system calls that Spark's readers and writers do not offer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern names, in one call to the file system."""
    fs, target = _resolve(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(target) or [])


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; empty when the folder is missing."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in the place of an older one of its name."""
    fs, target = _resolve(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getLength()
