"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.joins import HOT_ROWS, hot_keys
from pairloom.sinks.files import delete

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_scopes: list[list[tuple[SparkSession, str]]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder set as ``spark.checkpoint.dir``. Where it is unset, one in the warehouse of the session, but only where
    driver and executors are one process: on a cluster each executor would write to a folder of its own."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


@contextmanager
def steps() -> Iterator[None]:
    """Tables staged inside are deleted at the end: the caller has by then written what it makes of them."""
    _scopes.append([])
    try:
        yield
    finally:
        for spark, path in _scopes.pop():
            delete(spark, path)


@dataclass(frozen=True)
class Staged:
    """A written table and its number of rows."""

    frame: DataFrame
    rows: int

    def hot(self, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
        """Hot values of ``key`` with their slots, found by counting, whatever the size of the table."""
        return hot_keys(self.frame, key, min_rows)


def stage(df: DataFrame, name: str) -> Staged:
    """Write ``df`` once and go on from the written table.

    Lost executors then cost no recomputation, and later steps read only the columns they need. The rows
    are counted while they are written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append((spark, path))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return Staged(spark.read.schema(df.schema).parquet(path), seen.get["rows"])
