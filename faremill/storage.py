"""Directory operations through Hadoop's FileSystem, so any storage Spark reads will do."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, none if it does not exist."""
    fs, target = _fs(spark, path)
    return [found.getPath().getName() for found in fs.listStatus(target)] if fs.exists(target) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes stored below ``path``, 0 if it does not exist."""
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, source = _fs(spark, path)
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="faremill-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/faremill-{purpose}-{uuid.uuid4().hex[:12]}"
