"""Tables between the steps of an operator, kept where all executors read them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_scopes: list[list[DataFrame]] = []


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a folder of the warehouse, but only where driver and
    executors are one process: on a cluster each executor would write to a folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_steps"


def written(df: DataFrame, name: str, result: bool = False) -> DataFrame:
    """``df`` written once and read back: lost executors cost no earlier step, and joins that read it can be
    split by adaptive execution, as both their sides come straight from a shuffle. A ``result`` outlives ``steps``."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    if _scopes and not result:
        _scopes[-1].append(table)
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of ``written`` tables. Whatever reads them must have run; a table dropped before is passed over."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def steps() -> Iterator[None]:
    """What is written inside is deleted at the end, when the caller has stored its result elsewhere."""
    _scopes.append([])
    try:
        yield
    finally:
        dropped(*_scopes.pop())


def carried(names: tuple[str, ...], back: bool = False) -> list[Column]:
    """Columns that an operator passes on under names that clash with none of its own, or (``back``) as they were."""
    if back:
        return [F.col(f"_carried_{i}").alias(c) for i, c in enumerate(names)]
    return [F.col(f"`{c}`").alias(f"_carried_{i}") for i, c in enumerate(names)]


def for_long_texts(spark: SparkSession) -> None:
    """Batches of a thousand rows go to Python workers: the default of ten thousand whole texts, held on both sides,
    is much of an executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    for_long_texts(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(spark: SparkSession, name: str, data: bytes) -> str:
    """Path of a file with ``data`` in the shared folder, whatever file system that is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(data))
    out.close()
    return path.toString()
