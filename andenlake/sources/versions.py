"""Versions of a group of tables: written aside, checked, then made the current one.

A root folder holds one folder for each version and a pointer file with the name of the
current one. Readers resolve the pointer, so they see either all tables of the version
before or all of the new one. The pointer is replaced by a rename, which is one step.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTER = "CURRENT"


class NoVersion(FileNotFoundError):
    """Nothing has been published under the root yet."""


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def new(root: str) -> str:
    """Folder of a version that nobody reads yet."""
    return f"{root}/version={uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Make a written version the current one."""
    files = _files(spark, root)
    draft = _path(spark, f"{root}/{POINTER}-{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(version.rpartition("/")[2].encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(files.makeQualified(draft), files.makeQualified(
        _path(spark, f"{root}/{POINTER}")), options)


def current(spark: SparkSession, root: str) -> str:
    """Folder of the current version."""
    pointer = f"{root}/{POINTER}"
    if not _files(spark, root).exists(_path(spark, pointer)):
        raise NoVersion(f"no version is published under {root}")
    return f"{root}/{spark.read.text(pointer, wholetext=True).first()[0].strip()}"


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a version that was not published, or that no reader uses any more."""
    _files(spark, folder).delete(_path(spark, folder), True)


def others(spark: SparkSession, root: str) -> list[str]:
    """Folders of all versions but the current one."""
    now = current(spark, root).rpartition("/")[2]
    found = _files(spark, root).globStatus(_path(spark, f"{root}/version=*")) or []
    names = [status.getPath().getName() for status in found]
    return [f"{root}/{name}" for name in names if name != now]
