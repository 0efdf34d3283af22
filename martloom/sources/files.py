"""Small file-system steps of the driver, through Spark's own Hadoop file system.

They touch names and short texts only. They use the session's JVM, so they need a
classic session.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThereError(Exception):
    """The name a file was to get is taken."""


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(_conf(spark))


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _at(spark, path)
    return system.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    where, system = _at(spark, folder)
    if not system.exists(where):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(where))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Whole paths that match a pattern, in order."""
    where, system = _at(spark, pattern)
    found = system.globStatus(where)
    return sorted(f.getPath().toString() for f in found or [])


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the file system spells it."""
    where, system = _at(spark, path)
    return system.makeQualified(where).toString()


def read_text(spark: SparkSession, path: str) -> str:
    where, system = _at(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Give ``text`` the name ``path`` in one step; refuse if the name is taken.

    The text is written under a temporary name and renamed without overwriting, so
    readers see all of it or nothing, and of two writers one fails.
    """
    final, system = _at(spark, path)
    temporary, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(temporary, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    never = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        fs.FileContext.getFileContext(system.getUri(), _conf(spark)).rename(temporary, final, never)
    except Py4JJavaError as error:
        system.delete(temporary, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise AlreadyThereError(path) from error
        raise


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; the folder of the new name is made if need be."""
    old, system = _at(spark, source)
    new, _ = _at(spark, target)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    where, system = _at(spark, path)
    system.delete(where, True)
