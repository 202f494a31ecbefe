"""Small files and folder listings on whatever store a path names, through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, in order; none if there is no such folder."""
    system, where = _at(spark, folder)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there with all its text or not at all.

    It is written under another name, which no reader looks at, and renamed. A file
    that is there already is never replaced.
    """
    system, where = _at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.part")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(where) or not system.rename(beside, where):
        system.delete(beside, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; nothing happens if it is not there."""
    system, where = _at(spark, path)
    system.delete(where, True)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move all files of one folder into another, which is made if it is not there."""
    system, where = _at(spark, target)
    system.mkdirs(where)
    jvm = spark._jvm.org.apache.hadoop.fs
    for name in names(spark, source):
        if not name.startswith((".", "_")) and not system.rename(jvm.Path(source, name), jvm.Path(target, name)):
            raise FileExistsError(f"{target}/{name}")
