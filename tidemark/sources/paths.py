"""Files and folders on any file system that Spark reads: local, HDFS or an object store."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *parts[1:]])


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.exists(at)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a folder that Spark wrote was committed."""
    return exists(spark, join(path, "_SUCCESS"))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    at, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files in a folder, sorted."""
    at, fs = _at(spark, path)
    plain = lambda p: p.toUri().getPath() if "://" not in path and not path.startswith("file:") else p.toString()
    return sorted(plain(s.getPath()) for s in fs.listStatus(at) if s.isFile())


def make(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.mkdirs(at)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _at(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside, flush, rename over: a reader sees the old text or the new one. Needs a file system with an atomic rename."""
    if "://" not in path and not path.startswith("file:"):
        return _replace_local(path, text)
    jvm = spark._jvm
    at, fs = _at(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside)
    out.write(bytearray(text.encode()))
    out.hsync()
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(aside, at, options)


def _replace_local(path: str, text: str) -> None:
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(aside, "w") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(aside, path)
    folder = os.open(os.path.dirname(path) or ".", os.O_RDONLY)
    try:
        os.fsync(folder)
    finally:
        os.close(folder)
