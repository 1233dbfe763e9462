"""File operations on whatever store a path names, through Hadoop's file systems.

They run on the driver and touch names only, never data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _located(spark, path)
    return bool(fs.exists(at))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it; nothing happens if it isn't there."""
    fs, at = _located(spark, path)
    fs.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it isn't there."""
    fs, at = _located(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, at = _located(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that must not exist yet; readers see it whole or not at all."""
    fs, target = _located(spark, path)
    _, staged = _located(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    stream = fs.create(staged, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(staged, target):
        fs.delete(staged, False)
        raise FileExistsError(path)


def replace(spark: SparkSession, staged: str, final: str) -> None:
    """Move a complete folder to ``final``, in place of what is there.

    Two renames: between them ``final`` is absent for a moment, which readers
    report as a missing table; the old version is deleted last.
    """
    fs, source = _located(spark, staged)
    _, target = _located(spark, final)
    _, old = _located(spark, f"{staged}.old")
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"can't move {final} aside")
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        fs.rename(old, target)
        raise OSError(f"can't move {staged} to {final}")
    fs.delete(old, True)
