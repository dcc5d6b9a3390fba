"""Small files in the shared storage, by Spark's own file system layer (any scheme that Spark reads)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    fs, p = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern with ``*`` finds."""
    fs, p = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def stamps(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of a file, or of the files below a folder."""
    fs, p = _path(spark, path)
    out, found = [], fs.listFiles(p, True) if fs.exists(p) else None
    while found is not None and found.hasNext():
        s = found.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def read(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all: under another name first, then renamed."""
    fs, target = _path(spark, path)
    _, hidden = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(hidden, target):
        fs.delete(hidden, False)
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)
