"""Small files and folders of a table's own bookkeeping, through Hadoop's file systems (local, HDFS, object stores)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> dict[str, int]:
    """Entries of a folder and the time each was last changed (ms); none if the folder is missing."""
    _, p, fs = _at(spark, path)
    return {f.getPath().getName(): f.getModificationTime() for f in fs.listStatus(p)} if fs.exists(p) else {}


def read_text(spark: SparkSession, path: str) -> str:
    jvm, p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A whole file or none: written under a hidden name, then renamed."""
    jvm, p, fs = _at(spark, path)
    hidden = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex[:8]}")
    out = fs.create(hidden, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(hidden, p):
        raise OSError(f"cannot write {path}")


def delete(spark: SparkSession, path: str) -> None:
    _, p, fs = _at(spark, path)
    fs.delete(p, True)
