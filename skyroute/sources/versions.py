"""Versioned folders behind a small pointer file, in any store that Spark can write.

A new version is written beside the others; the pointer is replaced last, by a rename, so
readers see whole versions only and open one folder however many were ever written.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTER = "_current"


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def point_to(spark: SparkSession, root: str, version: int) -> None:
    """Make ``version`` the current one of ``root``."""
    target, fs = _files(spark, f"{root}/{POINTER}")
    fresh, _ = _files(spark, f"{root}/{POINTER}.new")
    out = fs.create(fresh, True)
    out.writeUTF(str(version))
    out.close()
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), how)


def current_version(spark: SparkSession, root: str | None) -> int | None:
    """The version that ``root`` points to; None if there is none yet."""
    if not root:
        return None
    target, fs = _files(spark, f"{root}/{POINTER}")
    if not fs.exists(target):
        return None
    f = fs.open(target)
    try:
        return int(f.readUTF())
    finally:
        f.close()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of a version that nobody reads any more, if it is there."""
    path, fs = _files(spark, folder)
    fs.delete(path, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or not at all; False, and nothing changed, if it is there already."""
    target, fs = _files(spark, path)
    if fs.exists(target):
        return False
    fresh, _ = _files(spark, f"{target.getParent()}/_{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    # without an overwriting option the rename fails where the target exists: the first writer wins
    how = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(fresh), fs.makeQualified(target), how)
    except Py4JJavaError as e:
        if not fs.exists(target):
            raise
        fs.delete(fresh, False)
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if it is not there."""
    target, fs = _files(spark, path)
    if not fs.exists(target):
        return None
    f = fs.open(target)
    try:
        return bytes(f.readAllBytes()).decode()
    finally:
        f.close()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    target, fs = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()] if fs.exists(target) else []


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder."""
    target, fs = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
