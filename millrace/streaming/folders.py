"""Folders of a sink through Spark's own file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if it does not exist."""
    files, target = _opened(spark, path)
    if not files.exists(target):
        return []
    names = [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def remove(spark: SparkSession, path: str) -> None:
    files, target = _opened(spark, path)
    files.delete(target, True)
