"""Folders of the store that Spark reads and writes: exists, publish, remove."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _store(spark, path)
    return bool(fs.exists(p))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether Spark finished writing the folder (its success marker is there)."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def publish(spark: SparkSession, built: str, path: str) -> bool:
    """Give a finished folder its name in one step; False (and ``built`` is removed) if the name is taken."""
    fs, p, jvm = _store(spark, path)
    fs.mkdirs(p.getParent())
    if not fs.exists(p) and fs.rename(jvm.org.apache.hadoop.fs.Path(built), p):
        return True
    remove(spark, built)
    return False


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _store(spark, path)
    fs.delete(p, True)


def stamp(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of the input's files: their paths, lengths and times of change.

    Lists folders, reads no file. Hidden files (``_`` or ``.`` first) are not
    input; a path that is missing raises.
    """
    lines = []
    for path in paths:
        fs, p, _ = _store(spark, path)
        if fs.getFileStatus(p).isFile():
            status = fs.getFileStatus(p)
            lines.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
            continue
        files = fs.listFiles(p, True)
        while files.hasNext():
            status = files.next()
            if not status.getPath().getName().startswith(("_", ".")):
                lines.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(lines)).encode()).hexdigest()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; none if it is missing."""
    fs, p, _ = _store(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
