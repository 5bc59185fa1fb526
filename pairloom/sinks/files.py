"""Single files and folders of any file system that Spark writes to."""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path with its scheme."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(where)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, if it is there."""
    system, where = _located(spark, path)
    system.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _located(spark, path)
    return system.exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    system, where = _located(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Writes ``text`` beside ``path`` and renames it: whoever reads the file finds the old text or the new one, whole."""
    system, where = _located(spark, path)
    system.mkdirs(where.getParent())
    _, new = _located(spark, f"{where}.{uuid.uuid4().hex}")
    out = system.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()).rename(new, where, options)


def text_of(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
