"""The few file-system calls a mart needs, on whatever store holds it."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _resolve(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder."""
    target, fs = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> bool:
    target, fs = _resolve(spark, path)
    return fs.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a new small file whole, or fails if there is one: under a name of its own, then renamed without overwriting.

    On file systems whose rename isn't one step, such as object stores, the store's own
    conditional writes or a lock outside must keep two writers apart.
    """
    target, fs = _resolve(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    part = hadoop.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    files = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    once = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    once[0] = hadoop.Options.Rename.NONE
    try:
        files.rename(files.makeQualified(part), files.makeQualified(target), once)
    except (Py4JJavaError, PySparkException) as error:
        fs.delete(part, False)
        raise RuntimeError(f"another writer already committed {path}") from error


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
