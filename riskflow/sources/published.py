"""Outputs replaced in two phases: a new version is written whole into a folder of its own, then a pointer moves to it.

A run that fails before the pointer has moved leaves the last version as it was, and readers of that version go on. The
pointer is a small file beside the versions; it lists the published ones, the latest first, and is replaced by one rename.
A path without a pointer is read as plain data. Of two runs that publish at once the later one wins.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "_current"


def _file(spark: SparkSession, path: str):
    """The path and its file system, as Hadoop objects."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    target, files = _file(spark, path)
    files.delete(target, True)


def published_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the versions that can be read, the latest first; none if nothing was published at `path`."""
    pointer, files = _file(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return []
    stream = files.open(pointer)
    try:
        names = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()
    return [f"{path}/{name}" for name in names]


def current_path(spark: SparkSession, path: str) -> str:
    """Where the latest version of the data lies: `path` itself for plain data."""
    return next(iter(published_versions(spark, path)), path)


def _move_pointer(spark: SparkSession, path: str, names: list[str]) -> None:
    jvm = spark._jvm
    new, files = _file(spark, f"{path}/{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(new)
    try:
        stream.write(bytearray("\n".join(names), "utf-8"))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), how)


def publish(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Let `write` fill a new folder, make it the current version of `path` and return it.

    The last `keep` versions stay, so that whoever still reads the one before can end; older ones are deleted. If `write`
    fails its folder is deleted and nothing else changes. Files at `path` that were not published here are left alone.
    """
    if keep < 1:
        raise ValueError("keep at least the current version")
    name = f"version-{uuid.uuid4().hex}"
    target = f"{path}/{name}"
    try:
        write(target)
    except BaseException:
        _delete(spark, target)
        raise
    before = [old.rsplit("/", 1)[1] for old in published_versions(spark, path)]
    _move_pointer(spark, path, [name, *before][:keep])
    for old in before[keep - 1 :]:
        _delete(spark, f"{path}/{old}")
    return target
